"""Operator 9: token counts by a compiled finite-state tokenizer.

The tokenizer is compiled, state by state, into a deterministic transducer over
characters (:mod:`curiota.llm.bpe`) whose transitions carry the number of
tokens they emit; no text is merged.  Texts are cut into chunks at
synchronising gaps, where every state goes to the start state: a chunk's state
map is one number, and maps compose by adding up.  Chunks are read in lockstep
and their maps composed by a prefix scan (a cumulative sum).  A chunk without
such a gap keeps its state from block to block.

A null or empty text has no tokens; rows are independent, so rows that repeat or
have no id each get their own count, and ties cannot arise.  An empty table
gives an empty one.  Very long texts are read in blocks of constant size.
Columns other than the two named are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from curiota.llm.arrow import map_columns
from curiota.llm.bpe import transducer


def count_tokens(
    df: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for every text."""

    def make():
        machine = transducer(path)

        def work(keys, texts):
            texts = [t or "" for t in texts]
            tokens = machine.counts(texts)
            return [keys, [len(t.encode("utf-8")) for t in texts], tokens, [n > limit for n in tokens]]

        return work

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(
        df, [id_col, text_col], make, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
