"""Order change rows (all changes, not net changes) -> current order state.

The latest change of each order wins (by ``change_seq``, whatever the
arrival order); an order whose latest change is a delete is absent.
Planned as a grouped ``max`` over a struct led by ``change_seq``: partial
aggregation on every input partition, so an order with a huge change
history costs one row per map task in the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import ORDER_CHANGE_SCHEMA, ORDER_COLUMNS, STATE_BUCKETS
from tidemark.session import file_system, files_under


# The latest change of an order, as the state table holds it.
STATE_SCHEMA = T.StructType([ORDER_CHANGE_SCHEMA[n] for n in ("order_id", "change_seq", "op", *ORDER_COLUMNS[1:])])


def current_state(changes: DataFrame) -> DataFrame:
    """``order_id, customer_name, product_name, amount, status, created_at, last_change_seq``."""
    return _live(last_changes(changes))


def _live(last: DataFrame) -> DataFrame:
    return last.filter(F.col("op") != F.lit("delete")).select(*ORDER_COLUMNS, F.col("change_seq").alias("last_change_seq"))


def last_changes(changes: DataFrame) -> DataFrame:
    """The latest change row of each order, deletes included."""
    latest = F.max(F.struct("change_seq", "op", *ORDER_COLUMNS[1:])).alias("last")
    return changes.groupBy("order_id").agg(latest).select("order_id", "last.*")


class StateTable:
    """The latest change of every order in hash buckets, kept up to date by a change stream.

    A micro-batch reads the buckets of its orders, folds its changes in and writes these buckets
    anew, under a folder of its own; all other buckets stay as they are, files and names. The writer's success mark
    commits a micro-batch: until then readers see the buckets before it. Deletes stay as rows: an older change that
    comes later must not bring the order back. A micro-batch that runs again writes the same buckets from the versions
    before it; of each bucket the version before the last is kept for that.

    ``buckets`` is fixed with the first micro-batch; choose it so that a bucket is some 100 MB. A new number needs a new table.
    """

    def __init__(self, path: str, buckets: int = STATE_BUCKETS):
        self.path, self.buckets = path, buckets
        self.targets = [path]

    def _versions(self, spark) -> dict[int, list[int]]:
        """The committed micro-batches that wrote each bucket, in order."""
        names = [n for n, _, _ in files_under(spark, self.path)]
        done = {int(n.rsplit("/batch_id=", 1)[1].split("/")[0]) for n in names if n.endswith("/_SUCCESS") and "/batch_id=" in n}
        out: dict[int, set[int]] = {}
        for n in names:
            if "/bucket=" in n:
                batch = int(n.rsplit("/batch_id=", 1)[1].split("/")[0])
                if batch in done:
                    out.setdefault(int(n.rsplit("/bucket=", 1)[1].split("/")[0]), set()).add(batch)
        return {b: sorted(v) for b, v in out.items()}

    def _read(self, spark, newest: dict[int, int]) -> DataFrame | None:
        """The rows of buckets as given micro-batches left them."""
        paths = [f"{self.path}/batch_id={batch}/bucket={b}" for b, batch in sorted(newest.items())]
        return spark.read.schema(STATE_SCHEMA).parquet(*paths) if paths else None

    def _bucket(self):
        return F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = last_changes(batch.select("change_seq", "op", *ORDER_COLUMNS)).persist()
        try:
            touched = [r[0] for r in rows.select(self._bucket()).distinct().collect()]  # no more than there are buckets
            before = {b: [v for v in vs if v < batch_id] for b, vs in self._versions(spark).items()}
            state = self._read(spark, {b: vs[-1] for b, vs in before.items() if vs and b in touched})
            merged = rows if state is None else last_changes(rows.unionByName(state))
            placed = merged.select(*[f.name for f in STATE_SCHEMA], self._bucket().alias("bucket"))
            if state is not None or touched:
                placed = placed.repartition("bucket")  # a bucket is a file
            placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch_id={batch_id}")
        finally:
            rows.unpersist()
        for b in touched:
            for old in before.get(b, [])[:-1]:
                fs, gone = file_system(spark, f"{self.path}/batch_id={old}/bucket={b}")
                fs.delete(gone, True)

    def read(self, spark) -> DataFrame:
        """The current state, as `current_state` gives it."""
        versions = self._versions(spark)
        if not versions and not files_under(spark, self.path):
            raise FileNotFoundError(f"no state at {self.path}")
        state = self._read(spark, {b: vs[-1] for b, vs in versions.items()})
        return _live(spark.createDataFrame([], STATE_SCHEMA) if state is None else state)


def change_images(changes: DataFrame) -> DataFrame:
    """One row for each change: ``commit_seq, seq, order_id, op, before, after, changed``.

    The feed has two rows for an update, its row before (``update_before``) and after (``update_after``), one for an
    insert or a delete. The two are paired by (commit, sequence in it, order) in one aggregation: no window, no join. ``changed`` maps each column that
    differs to its old and new value as text. An insert has no row before, a delete none after; an update with
    one image alone keeps the other null and has no ``changed``. A row that was delivered twice counts once.
    """
    image = F.struct(*ORDER_COLUMNS[1:])
    old, new = F.col("op").isin("update_before", "delete"), F.col("op").isin("update_after", "insert")
    kind = F.min(F.when(F.col("op").startswith("update"), F.lit("update")).otherwise(F.col("op")))
    paired = changes.groupBy("commit_seq", "seq", "order_id", F.col("op").startswith("update").alias("update"), F.when(
        ~F.col("op").startswith("update"), F.col("op")).alias("single")).agg(
        kind.alias("op"), F.max(F.when(old, image)).alias("before"), F.max(F.when(new, image)).alias("after"))
    pairs = [F.when(~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")), F.struct(
        F.lit(c).alias("key"), F.struct(F.col(f"before.{c}").cast("string").alias("old"), F.col(f"after.{c}").cast("string").alias("new")).alias("value")))
        for c in ORDER_COLUMNS[1:]]
    changed = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p.isNotNull()))
    whole = (F.col("op") == "update") & F.col("before").isNotNull() & F.col("after").isNotNull()
    return paired.select("commit_seq", "seq", "order_id", "op", "before", "after", F.when(whole, changed).alias("changed"))
