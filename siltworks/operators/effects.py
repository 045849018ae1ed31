"""What steps do to a row: marks, flags, buckets and metrics as expressions.

Row-local steps are evaluated together.  A row ends at the first step that
drops it; effects of that step count, those of later ones do not.  The cut is
made afterwards on the marks, so Catalyst sees one projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import values as V

MARK = "array<struct<step:int,sev:int,reason:string>>"


@dataclass
class Effects:
    """Collected in step order; `at` is the step that now speaks."""

    steps: list[str] = field(default_factory=list)
    marks: list[Column] = field(default_factory=list)
    flags: list[Column] = field(default_factory=list)
    buckets: list[tuple[int, str, Column, bool]] = field(default_factory=list)
    metrics: list[tuple[int, str, Column]] = field(default_factory=list)
    renewed: dict[str, Column] = field(default_factory=dict)

    @property
    def at(self) -> int:
        return len(self.steps) - 1

    def step(self, name: str) -> None:
        self.steps.append(name)

    def mark(self, when: Column, severity: int, reason: str) -> None:
        self.marks.append(F.when(when, F.struct(F.lit(self.at).alias("step"), F.lit(severity).alias("sev"), F.lit(reason).alias("reason"))))

    def drop(self, when: Column, reason: str) -> None:
        self.mark(when, V.DROP, reason)

    def review(self, when: Column, reason: str, flag: bool = False) -> None:
        self.mark(when, V.REVIEW, reason)
        if flag:
            self.flags.append(F.when(when, F.struct(F.lit(self.at).alias("step"), F.lit(reason).alias("flag"))))

    def bucket(self, name: str, value: Column | str, keep_first: bool = False) -> None:
        """A label; null says nothing.  keep_first leaves an earlier one alone."""
        self.buckets.append((self.at, name, F.lit(value) if isinstance(value, str) else value, keep_first))

    def metric(self, name: str, value: Column) -> None:
        self.metrics.append((self.at, name, value.cast("double")))


def array_of(items: list[Column], kind: str) -> Column:
    return F.array_compact(F.array(*items)).cast(kind) if items else F.array().cast(kind)


def stop_step(marks: str = "marks") -> Column:
    """The first step that drops; null for rows that live."""
    return F.array_min(F.transform(F.filter(marks, lambda m: m.sev == V.DROP), lambda m: m.step))


def reached(step: int, stop: str = "stop_step") -> Column:
    return F.col(stop).isNull() | (F.lit(step) <= F.col(stop))


def map_of(pairs: dict[str, Column], kind: str) -> Column:
    """A map without the pairs whose value is null."""
    if not pairs:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<{kind}>"))
    full = F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), v.cast(kind))))
    return F.map_filter(full, lambda _, v: v.isNotNull())


def bucket_values(effects: list[tuple[int, str, Column, bool]]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for step, name, value, keep_first in effects:
        value = F.when(reached(step), value)
        if name not in out:
            out[name] = value
        else:
            out[name] = F.coalesce(out[name], value) if keep_first else F.coalesce(value, out[name])
    return out


def metric_values(effects: list[tuple[int, str, Column]]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for step, name, value in effects:
        value = F.when(reached(step), value)
        out[name] = F.coalesce(value, out[name]) if name in out else value
    return out


def severity(marks: str = "marks") -> Column:
    return F.coalesce(F.array_max(F.transform(marks, lambda m: m.sev)), F.lit(V.KEEP))


def decision_name(sev: Column) -> Column:
    return F.when(sev == V.DROP, "drop").when(sev == V.REVIEW, "review").otherwise("keep")


def trace(steps: list[str], marks: str = "marks", stop: str = "stop_step") -> Column:
    """array<string> of the counters a row adds to: seen by step, and each change of decision."""
    out = [F.lit("input")]
    for k, name in enumerate(steps):
        upto = lambda n: F.coalesce(F.array_max(F.transform(F.filter(marks, lambda m: m.step <= n), lambda m: m.sev)), F.lit(V.KEEP))
        before, after = upto(k - 1), upto(k)
        out.append(F.when(reached(k, stop), f"step.{name}.seen"))
        out.append(F.when(reached(k, stop) & (after > before), F.concat(F.lit(f"step.{name}."), decision_name(after))))
    out.append(F.concat(F.lit("output."), decision_name(severity(marks))))
    return F.array_compact(F.array(*out))
