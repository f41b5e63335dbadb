"""A table by key that takes micro-batches: deltas by bucket, folding, manifests, cleaning."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.ranking import latest
from tideline.sinks import files


class KeyedTable:
    """The newest row per key of all batches written so far.

    Keys are hashed to ``buckets``.  A batch is written once, as one delta folder for each bucket
    it touches; untouched buckets are neither read nor written.  A bucket with more than
    ``fold_after`` folders is folded to one in the commit that touches it.  So a key's bucket is
    rewritten once in ``fold_after`` commits at most, and never has more folders than that plus
    one.

    A commit counts when its manifest is there: one small file that names the folders of every
    bucket.  Readers open a manifest and see the state of that commit, whatever is written or
    folded meanwhile, until ``keep`` further commits have gone by; what no kept manifest names is
    removed.  A batch that is not newer than the last commit is a replay and changes nothing; one
    that failed before its manifest is overwritten.  One writer at a time.

    A bucket should hold about what one task reads well: the default suits some millions of rows.

    Newest is the greatest by ``order`` (nulls least), then by batch.  Without ``order`` a batch
    should hold a key once.  Null keys are a key.  With other ``buckets`` than the table was made
    with, the table's own number holds.
    """

    def __init__(
        self, path: str, keys: list[str], order: list[str] | None = None, buckets: int = 4, fold_after: int = 8, keep: int = 2
    ):
        self.path = path.rstrip("/")
        self.keys = keys
        self.order = order or []
        self.buckets = buckets
        self.fold_after = fold_after
        self.keep = keep

    # ------------------------------------------------------------------ manifests

    def _numbers(self, spark: SparkSession) -> list[int]:
        found = files.names(spark, f"{self.path}/manifests")
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json"))

    def _file(self, number: int) -> str:
        return f"{self.path}/manifests/{number:012}.json"

    def snapshot(self, spark: SparkSession) -> dict | None:
        """The last commit's manifest, to :meth:`read` the same state again."""
        numbers = self._numbers(spark)
        return json.loads(files.read_text(spark, self._file(numbers[-1]))) if numbers else None

    # ------------------------------------------------------------------ writing

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self.snapshot(spark)
        if before is not None and batch_id <= before["batch"]:
            return
        now = before or {"buckets": self.buckets, "parts": {}}
        now = {**now, "batch": batch_id, "schema": json.loads(batch.schema.json())}
        rows = latest(batch, self.keys, self.order) if self.order else batch
        touched = self._write(rows.withColumn("commit__", F.lit(batch_id).cast("long")), now["buckets"], f"{batch_id}")
        parts = {b: list(p) for b, p in now["parts"].items()}
        for bucket in touched:
            parts.setdefault(bucket, []).append(f"{batch_id}")
        now["parts"] = parts
        full = [b for b in touched if len(parts[b]) > self.fold_after]
        self._commit(spark, self._folded(spark, now, full))

    def _write(self, rows: DataFrame, buckets: int, name: str) -> list[str]:
        """Rows as folders by bucket; returns the buckets."""
        number = F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")
        target = f"{self.path}/data/commit={name}"
        # Rebalanced by bucket: one file for most buckets, several for a large one.
        dealt = rows.withColumn("bucket__", number).hint("rebalance", F.col("bucket__"))
        dealt.write.mode("overwrite").partitionBy("bucket__").parquet(target)
        found = files.names(rows.sparkSession, target)
        return [n.removeprefix("bucket__=") for n in found if n.startswith("bucket__=")]

    def _folded(self, spark: SparkSession, manifest: dict, buckets: list[str]) -> dict:
        """The manifest with each of these buckets rewritten as one folder."""
        if not buckets:
            return manifest
        name = f"{manifest['batch']}-folded-{len(self._numbers(spark))}-{max(self._numbers(spark), default=0)}"
        rows = self._newest(spark, manifest, buckets)
        self._write(rows, manifest["buckets"], name)
        return {**manifest, "parts": {**manifest["parts"], **{b: [name] for b in buckets}}}

    def _commit(self, spark: SparkSession, manifest: dict) -> None:
        numbers = self._numbers(spark)
        files.write_text(spark, self._file(numbers[-1] + 1 if numbers else 0), json.dumps(manifest))
        self._clean(spark)

    def _clean(self, spark: SparkSession) -> None:
        """Remove manifests beyond the kept ones and all folders that none of these names."""
        numbers = self._numbers(spark)
        used: dict[str, set[str]] = {}
        for number in numbers[-self.keep - 1 :]:
            for bucket, parts in json.loads(files.read_text(spark, self._file(number)))["parts"].items():
                for part in parts:
                    used.setdefault(f"commit={part}", set()).add(f"bucket__={bucket}")
        for number in numbers[: -self.keep - 1]:
            files.remove(spark, self._file(number))
        for commit in files.names(spark, f"{self.path}/data"):
            folder = f"{self.path}/data/{commit}"
            if commit not in used:
                files.remove(spark, folder)
                continue
            for bucket in files.names(spark, folder):
                if bucket.startswith("bucket__=") and bucket not in used[commit]:
                    files.remove(spark, f"{folder}/{bucket}")

    def fold(self, spark: SparkSession) -> int | None:
        """Fold all buckets now; returns the last batch in the table."""
        now = self.snapshot(spark)
        if now is None:
            return None
        many = [b for b, parts in now["parts"].items() if len(parts) > 1]
        if many:
            self._commit(spark, self._folded(spark, now, many))
        return now["batch"]

    # ------------------------------------------------------------------ reading

    def _rows(self, spark: SparkSession, manifest: dict, buckets: list[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"]).add("commit__", T.LongType())
        paths = [
            f"{self.path}/data/commit={part}/bucket__={bucket}"
            for bucket, parts in manifest["parts"].items()
            if buckets is None or bucket in buckets
            for part in parts
        ]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def _newest(self, spark: SparkSession, manifest: dict, buckets: list[str] | None = None) -> DataFrame:
        return latest(self._rows(spark, manifest, buckets), self.keys, [*self.order, "commit__"])

    def _known(self, spark: SparkSession, at: dict | None) -> dict:
        manifest = at or self.snapshot(spark)
        if manifest is None:
            raise FileNotFoundError(f"no commit in {self.path}")
        return manifest

    def versions(self, spark: SparkSession) -> DataFrame:
        """All rows that are stored, with the ``batch_id`` each came with."""
        return self._rows(spark, self._known(spark, None)).withColumnRenamed("commit__", "batch_id")

    def read(self, spark: SparkSession, at: dict | None = None) -> DataFrame:
        """The newest row per key as of a manifest, by default the last."""
        return self._newest(spark, self._known(spark, at)).drop("commit__")

    def lookup(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """The rows of some keys, from their buckets alone."""
        manifest = self._known(spark, None)
        number = F.pmod(F.xxhash64(*self.keys), F.lit(manifest["buckets"])).cast("int").cast("string")
        wanted = [r[0] for r in keys.select(number).distinct().collect()]  # at most one for each bucket
        return self._newest(spark, manifest, wanted).drop("commit__").join(keys.select(*self.keys).distinct(), self.keys, "left_semi")
