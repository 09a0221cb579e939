"""Operator 2: BPE encoding and decoding with bounded lookahead.

Every text runs through the streaming transducer of :mod:`curiota.llm.bpe`: a
token is emitted as soon as no continuation can change it, which the merge
list's sufficient lookahead bounds, and only bytes that are not settled are
kept.  Texts go in blocks of constant size, and a decoder state takes the ids
of a block at a time, so neither ids nor text of a long document are held whole.

A null text counts as empty and gives no ids; an empty text likewise.  Rows are
independent: rows that repeat or have no id give their own results, and ties
cannot arise.  An empty table gives an empty one.  Columns other than the two
named are not read, so their names cannot clash.
"""

from __future__ import annotations

import codecs
import hashlib

from pyspark.sql import DataFrame

from curiota.llm.arrow import map_columns
from curiota.llm.bpe import merge_list, transducer


class StreamDecoder:
    """Ids to text: bytes of an unfinished character wait in the state machine."""

    def __init__(self, path: str):
        self.bytes_of = merge_list(path).bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        """Text that the ids complete."""
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        text = self.state.decode(b"", True)
        self.state.reset()
        return text


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids array<int>``: the token ids of every text."""

    def make():
        machine = transducer(path)

        def work(keys, texts):
            out: list[list[int]] = [[] for _ in keys]
            for i, ids in machine.encode([t or "" for t in texts]):
                out[i] += ids.tolist()
            return [keys, out]

        return work

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df, [id_col, text_col], make, f"`{id_col}` {kind}, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, text``: the text of every id list; null lists give empty text."""

    def make():
        dec = StreamDecoder(path)
        return lambda keys, lists: [keys, [dec.feed(x or []) + dec.finish() for x in lists]]

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df, [id_col, ids_col], make, f"`{id_col}` {kind}, text string")


def round_trip_digest(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: encode, decode and digest in one stream.

    Neither the ids nor the decoded text of a document are ever held whole.
    """

    def make():
        machine, dec = transducer(path), StreamDecoder(path)
        spelled = machine.merges.decimal

        def work(keys, texts):
            counts, ids_sha, text_sha = [0] * len(keys), [], []
            at = -1

            def up_to(number):
                nonlocal at
                while at < number:  # the text before is over: its last bytes leave the decoder
                    if at >= 0:
                        text_sha[at].update(dec.finish().encode("utf-8"))
                    ids_sha.append(hashlib.sha256())
                    text_sha.append(hashlib.sha256())
                    at += 1

            for number, found in machine.encode([t or "" for t in texts]):
                up_to(number)
                ids = found.tolist()
                if ids:
                    joined = ",".join(map(spelled.__getitem__, ids))
                    ids_sha[at].update(("," + joined if counts[at] else joined).encode())
                    counts[at] += len(ids)
                    text_sha[at].update(dec.feed(ids).encode("utf-8"))
            up_to(len(keys))
            return [keys, counts, [h.hexdigest() for h in ids_sha[: len(keys)]], [h.hexdigest() for h in text_sha[: len(keys)]]]

        return work

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_columns(df, [id_col, text_col], make, schema)
