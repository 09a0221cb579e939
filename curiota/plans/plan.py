"""Curation plans: YAML to validated steps, bound to a DataFrame as one lazy lineage.

    processing:
      - decimalLatitude: [{isboundedby: {operator: "<=", value: 90}}]
      - tool: [{islatlonzero: {latkey: decimalLatitude, lonkey: decimalLongitude}}]
    postprocessing:
      - species_id: [{lowerbound: {limit: 10}}]
    variables:
      decimalLatitude: {rename: lat, type: float}
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

import curiota.operators.marine
import curiota.operators.quota
import curiota.operators.selection
import curiota.operators.taxonomy
import curiota.operators.temporal
import curiota.operators.transforms  # noqa: F401  (operators register themselves)
from curiota.functions.naming import current
from curiota.functions.nulls import stdnan
from curiota.operators.registry import REGISTRY, Operator
from curiota.operators.transforms import cast_to, select_columns
from curiota.plans.steps import ENGINE_ONLY, FIXED, known

MULTI = "tool"
#: Land filters reduce rows before anything else; review comes first afterwards.
FIRST = ("format", "marineloc", "island")
REVIEW = "resolvetaxamatch"


#: Where a plan reads and writes; the command line uses them.
PATHS = ("inputfile", "outputfile", "sep", "inputfile_path", "inputdir_path", "outputdir_path", "outputfile_path")


class PlanError(ValueError):
    """A plan that cannot run, found before any data is read."""


@dataclass(frozen=True)
class Step:
    column: str
    operator: Operator
    parameters: dict

    def __call__(self, df: DataFrame, resources: dict) -> DataFrame:
        defaults = {k: p.default for k, p in self.operator.parameters.items() if isinstance(p.default, str) and p.default.startswith("$")}
        given = defaults | self.parameters
        given = {k: resources.get(v[1:], v) if isinstance(v, str) and v.startswith("$") else v for k, v in given.items()}
        args = [] if self.column == MULTI else [self.column]
        return self.operator.function(df, *args, **given)


@dataclass
class CurationPlan:
    processing: list[Step] = field(default_factory=list)
    postprocessing: list[Step] = field(default_factory=list)
    variables: dict[str, dict] = field(default_factory=dict)
    standardize_missing: bool = True

    def normalize(self) -> CurationPlan:
        """Row-reducing land filters to the front, review to the front of postprocessing."""
        self.processing.sort(key=lambda s: FIRST.index(s.operator.name) if s.operator.name in FIRST else len(FIRST))
        self.postprocessing.sort(key=lambda s: s.operator.name != REVIEW)
        return self

    def apply(self, df: DataFrame, resources: dict | None = None, statistics: list | None = None) -> DataFrame:
        """The whole plan as one lineage.  ``statistics`` collects an Observation per step.

        ``resources`` holds what YAML cannot: tables and masks, named ``$name`` in parameters.
        """
        out = stdnan(df) if self.standardize_missing else df
        casts = {found: v["type"] for k, v in self.variables.items() if (v or {}).get("type") and (found := current(out.columns, k))}
        if casts:
            out = out.withColumns({c: F.coalesce(cast_to(F.col(f"`{c}`"), t).cast("string"), F.col(f"`{c}`").cast("string")) if t == "str" else cast_to(F.col(f"`{c}`"), t) for c, t in casts.items()})
        for i, step in enumerate([*self.processing, *self.postprocessing]):
            out = step(out, resources or {})
            if statistics is not None:
                seen = Observation(f"{i}_{step.operator.name}")
                out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
                statistics.append((step.column, step.operator.name, seen))
        return select_columns(out, self.variables) if self.variables else out


def _boolean(value):
    """``'True'`` and ``'False'`` as text are Booleans; everything else stays."""
    return {"True": True, "False": False}.get(value, value) if isinstance(value, str) else value


def _steps(section, allowed: set[str], where: str) -> list[Step]:
    out = []
    items = section.items() if isinstance(section, dict) else [kv for entry in section or [] for kv in entry.items()]
    for column, operators in items:
        for entry in operators if isinstance(operators, list) else [operators]:
            entry = {entry: {}} if isinstance(entry, str) else entry
            for name, parameters in entry.items():
                meant = known(name)
                if meant is None or meant.kind not in allowed:
                    raise PlanError(f"{where}: {name} is not an operator of this section")
                if meant.keyed == (column == MULTI):
                    raise PlanError(f"{where}: {name} goes under {'a column' if meant.keyed else MULTI!r}")
                given = {k: _boolean(v) for k, v in (parameters or {}).items()}
                for k in FIXED.keys() & given.keys() - set(meant.parameters):
                    if given.pop(k) != FIXED[k]:
                        raise PlanError(f"{where}: {name} has no {k} other than {FIXED[k]}")
                parameters = {k: v for k, v in given.items() if k in meant.parameters or k not in ENGINE_ONLY}
                try:
                    meant.check(parameters)
                except TypeError as error:
                    raise PlanError(f"{where}: {error}") from None
                out.append(Step(column, meant, parameters))
    return out


def _variable(how) -> dict:
    """``type``, ``{rename: …, type: …}`` or ``{new name: type}``."""
    if isinstance(how, str):
        return {"type": how}
    how = dict(how or {})
    if set(how) <= {"rename", "type"}:
        return how
    (name, kind), *rest = how.items()
    if rest:
        raise PlanError(f"variables: one new name expected, got {sorted(how)}")
    return {"rename": name} | ({"type": kind} if kind else {})


def from_dict(config: dict) -> CurationPlan:
    """Validate a plan; every problem is a :class:`PlanError` before anything runs."""
    data = config.get("data", config)
    if unknown := sorted(set(data) - {"processing", "postprocessing", "variables", "standardize_missing", *PATHS}):
        raise PlanError(f"unknown sections {unknown}")
    variables = {}
    raw = data.get("variables") or {}
    for key, how in raw.items() if isinstance(raw, dict) else [kv for e in raw for kv in (e.items() if isinstance(e, dict) else [(e, {})])]:
        variables[key] = _variable(how)
    return CurationPlan(
        _steps(data.get("processing"), {"selection", "transformation"}, "processing"),
        _steps(data.get("postprocessing"), {"postprocessing", "selection", "transformation"}, "postprocessing"),
        variables,
        _boolean(data.get("standardize_missing", True)),
    ).normalize()


def load(path: str | Path) -> tuple[CurationPlan, dict]:
    """A plan and the raw configuration from a YAML file."""
    import yaml

    config = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    return from_dict(config), config.get("data", config)


def pipeline(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Compose transforms for use without YAML."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run
