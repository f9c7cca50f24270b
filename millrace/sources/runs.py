"""Published runs: tables with a manifest of what went in and came out, and a pointer that is swapped last.

Rows and a content digest are observed while a table is written, so a manifest costs no other scan. A run that fails its checks,
or dies, is never pointed to. Readers compare what they read with the manifest."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST, CURRENT = "manifest.json", "CURRENT"


def _digest(df: DataFrame) -> tuple[Column, Column]:
    """Rows and a digest of them that their order doesn't change: 126 bits, the sums of two halves of each row's MD5."""
    md5 = F.md5(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    half = lambda at: F.sum(F.conv(F.substring(md5, at, 15), 16, 10).cast("decimal(38,0)"))
    return F.count("*").alias("rows"), F.concat_ws("-", F.coalesce(half(1), F.lit(0)).cast("string"), F.coalesce(half(17), F.lit(0)).cast("string")).alias("digest")


def fingerprint(df: DataFrame) -> dict:
    """rows, digest and schema of a table."""
    one = df.agg(*_digest(df)).first()
    return {"rows": one["rows"], "digest": one["digest"], "schema": df.schema.simpleString()}


class Runs:
    """Runs under a folder, one of them current."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read(self, *names: str) -> str | None:
        if not self._fs().exists(self._path(*names)):
            return None
        with_stream = self._fs().open(self._path(*names))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(with_stream, "UTF-8")
        finally:
            with_stream.close()

    def _write(self, text: str, *names: str) -> None:
        """Whole or not at all: written beside, then moved over."""
        beside = self._path(*names[:-1], f"_{names[-1]}")
        out = self._fs().create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self.spark._jsc.hadoopConfiguration())
        rename = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(beside, self._path(*names), options)

    def current(self) -> str | None:
        return self._read(CURRENT)

    def manifest(self, run: str | None = None) -> dict:
        """A run's manifest, the current one's if none is named."""
        run = run or self.current()
        text = run and self._read(run, MANIFEST)
        if not text:
            raise ValueError(f"no published run {run or ''} under {self.root}".replace("  ", " "))
        return json.loads(text)

    def publish(self, run: str, outputs: dict[str, DataFrame], inputs: dict[str, DataFrame] | None = None, check: Callable[[dict], list[str]] = lambda counts: []) -> dict:
        """Write a run's tables, check the rows observed, write the manifest and point to the run. Returns the manifest; its
        `unchanged` says whether all tables equal those of the run before, which then stays the current one.

        check takes {table: rows} and returns what is wrong with them, which makes the run an error and leaves it unpublished."""
        if self._fs().exists(self._path(run)):
            raise FileExistsError(f"{self.root}/{run}")
        last = self.manifest() if self.current() else None
        written = {}
        for name, df in outputs.items():
            seen = Observation()
            df.observe(seen, *_digest(df)).write.parquet(f"{self.root}/{run}/{name}")
            written[name] = {**seen.get, "schema": df.schema.simpleString()}
        problems = check({name: x["rows"] for name, x in written.items()})
        if problems:
            raise ValueError("; ".join(problems))
        told = {"run": run, "inputs": {name: fingerprint(df) for name, df in (inputs or {}).items()}, "outputs": written}
        told["unchanged"] = last is not None and last["outputs"] == written
        self._write(json.dumps(told, sort_keys=True, indent=2), run, MANIFEST)
        if not told["unchanged"]:
            self._write(run, CURRENT)
        return told

    def read(self, name: str, run: str | None = None, verify: bool = True) -> DataFrame:
        """A table of a run. verify: read it once more to compare it with the manifest; a difference is an error."""
        told = self.manifest(run)
        if name not in told["outputs"]:
            raise ValueError(f"{told['run']} has no table {name}")
        df = self.spark.read.parquet(f"{self.root}/{told['run']}/{name}")
        if verify and fingerprint(df) != told["outputs"][name]:
            raise ValueError(f"{name} isn't what {told['run']} published")
        return df

    def same_inputs(self, inputs: dict[str, DataFrame], run: str | None = None) -> list[str]:
        """Names of inputs that differ from those a run was made of."""
        told = self.manifest(run)["inputs"]
        return sorted(name for name in {*told, *inputs} if name not in inputs or told.get(name) != fingerprint(inputs[name]))
