"""A resumable run of named stages, each written as a table, with a stats row of dates, seconds and errors."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Config:
    """Run parameters; defaults are overridden by files, then by arguments."""

    min_flank: int = 10
    max_flank: int = 60
    min_support: int = 2
    ploidy: int = 2
    keep_pcr_dups: bool = True
    profile_cutoff: float = 0.85
    cluster_cutoff: float = 0.88
    flank_cutoff: float = 0.90

    @classmethod
    def load(cls, *texts: str, **given) -> Config:
        """KEY=VALUE texts in rising precedence, # comments, keys in either case; given values win."""
        kinds = {f.name: f.type for f in fields(cls)}
        out = {}
        for text in texts:
            for line in text.splitlines():
                key, eq, value = line.partition("#")[0].partition("=")
                if eq and (k := key.strip().lower()) in kinds:
                    v = value.strip()
                    out[k] = v.lower() in ("1", "true", "yes") if kinds[k] == "bool" else float(v) if kinds[k] == "float" else int(v)
        config = cls(**out | given)
        if config.ploidy < 1 or config.min_support < 1 or config.min_flank < 0:
            raise ValueError("ploidy and min_support are at least 1, min_flank at least 0")
        return config


#: Layout of a run's folder; a folder of another one isn't resumed.
VERSION = 1


class PostConditionError(RuntimeError):
    """What was written isn't what was counted."""


def require_count(what: str, counted: int, written: int) -> None:
    """Stops unless as many rows were written as were counted."""
    if counted != written:
        raise PostConditionError(f"{what}: {counted} counted, {written} written")


class Run:
    """Stages in order. A stage is a function of (spark, earlier outputs by name); a written stage isn't run again.

    checks holds, by stage, a function of (spark, earlier outputs, the stage's output) that raises if a post-condition fails. Stats (seconds, date,
    rows and errors by stage) stand in the run's folder, so they outlive the session: an error stops later runs until clear().
    """

    def __init__(self, spark: SparkSession, path: str, stages: list[tuple[str, Callable[[SparkSession, dict[str, DataFrame]], DataFrame]]], checks: dict[str, Callable] | None = None):
        self.spark, self.path, self.stages, self.checks = spark, path.rstrip("/"), stages, checks or {}
        self.stats: dict[str, dict] = {}
        if self._at("stats.json").exists():
            kept = json.loads("".join(r.value for r in spark.read.text(f"{self.path}/stats.json", wholetext=True).collect()))
            if kept["version"] != VERSION:
                raise ValueError(f"the run's folder has layout {kept['version']}, not {VERSION}")
            self.stats = kept["stages"]

    class _Place:
        def __init__(self, spark: SparkSession, path: str):
            self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
            self.files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

        def exists(self) -> bool:
            return self.files.exists(self.path)

        def delete(self) -> None:
            self.files.delete(self.path, True)

        def write(self, text: str) -> None:
            out = self.files.create(self.path, True)
            out.write(bytearray(text.encode()))
            out.close()

    def _at(self, name: str) -> Run._Place:
        return self._Place(self.spark, f"{self.path}/{name}")

    def _keep(self) -> None:
        self._at("stats.json").write(json.dumps({"version": VERSION, "stages": self.stats}))

    def _done(self, name: str) -> bool:
        return self._at(f"{name}/_SUCCESS").exists()

    def next_stage(self) -> int:
        """Index of the first stage without an output."""
        return next((i for i, (n, _) in enumerate(self.stages) if not self._done(n)), len(self.stages))

    def run(self, first: int = 0, last: int | None = None) -> dict[str, DataFrame]:
        """Runs stages first..last that have no output yet; an error is kept in stats and stops later stages until clear()."""
        if bad := next((n for n, s in self.stats.items() if "error" in s), None):
            raise RuntimeError(f"stage {bad} failed; clear it first")
        out: dict[str, DataFrame] = {}
        for i, (name, stage) in enumerate(self.stages):
            where = f"{self.path}/{name}"
            if i < first or (last is not None and i > last):
                if self._done(name):
                    out[name] = self.spark.read.parquet(where)
                continue
            if not self._done(name):
                began = time.time()
                try:
                    stage(self.spark, out).write.mode("overwrite").parquet(where)
                    made = self.spark.read.parquet(where)
                    if name in self.checks:
                        self.checks[name](self.spark, out, made)
                except Exception as e:
                    self._at(name).delete()
                    self.stats[name] = {"error": str(e)[:500]}
                    self._keep()
                    raise
                self.stats[name] = {"seconds": round(time.time() - began, 3), "date": time.strftime("%Y-%m-%d %H:%M:%S"), "rows": made.count()}
                self._keep()
            out[name] = self.spark.read.parquet(where)
        return out

    def report(self) -> str:
        """One line a stage: date, duration as days, hours, minutes and seconds, rows."""
        lines = []
        for name, _ in self.stages:
            s = self.stats.get(name, {})
            left, parts = int(s.get("seconds", 0)), []
            for unit, size in (("d", 86400), ("h", 3600), ("m", 60), ("s", 1)):
                parts.append(f"{left // size}{unit}")
                left %= size
            lines.append(f"{name}: {s['error'] if 'error' in s else ' '.join([s['date'], *parts, str(s['rows']) + ' rows']) if s else 'not run'}")
        return "\n".join(lines)

    def clear(self, first: int) -> None:
        """Forgets outputs and errors from a stage on."""
        first = min(max(first, 0), len(self.stages))
        for name, _ in self.stages[first:]:
            self._at(name).delete()
            self.stats.pop(name, None)
        self.stats = {n: s for n, s in self.stats.items() if "error" not in s}
        self._keep()
