"""Sinks: upserts without a row-level table format, append-once, and exports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut, ship


#: Which micro-batch wrote a row.
BATCH = "batch"


def _whole(keys: Sequence[str]) -> Column:
    """No key is null; a null in any key never conflicts with anything."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def _ranked(rows: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns in a form that can be compared: maps as JSON."""
    kinds = dict(rows.dtypes)
    return [F.to_json(F.struct(F.col(c))) if "map<" in kinds[c] else F.col(c) for c in columns]


def _one_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """One row of each whole key, by ``order``, ties by all other columns; rows with a null in a key all stay.

    An aggregate over structs combines on the map side, so a hot key is no hot task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    if not order and not rest:
        return rows.where(_whole(keys)).distinct().unionByName(rows.where(~_whole(keys)))
    rank = F.struct(*_ranked(rows, [*order, *rest]))
    best = rows.where(_whole(keys)).groupBy(*keys).agg(pick(F.struct(*order, *rest), rank).alias("__r"))
    merged = best.select(*[F.col(c) if c in keys else F.col(f"__r.`{c}`").alias(c) for c in rows.columns])
    return merged.unionByName(rows.where(~_whole(keys)))


def latest_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order`` and then by all other columns, so reruns agree."""
    return _one_per_key(rows, keys, order, F.max_by)


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The target after the delta overwrote its keys; within the delta the last row wins."""
    marked = target.withColumn("__new", F.lit(0)).unionByName(delta.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return latest_wins(marked, keys, ["__new", *order]).drop("__new")


def _joined(target: DataFrame, delta: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The target's rows with some columns taken from the delta, which has one row per key."""
    new = delta.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__hit"))
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(key) == F.col(f"__key_{key}"))
    joined = target.join(new, same, "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def update_columns(target: DataFrame, delta: DataFrame, key: str, columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows whose key the delta holds get its values for some columns; nothing is inserted.

    Of repeated delta keys the last by ``order`` counts, so no target row is multiplied.
    """
    last = latest_wins(delta.select(key, *dict.fromkeys([*order, *columns])).where(F.col(key).isNotNull()), [key], order)
    return _joined(target, last, [key], columns)


def narrow_upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """On a conflict only ``columns`` are overwritten; rows without one are inserted whole. A null key never conflicts."""
    last = latest_wins(delta, keys, order)
    fresh = last.join(target.select(*keys), list(keys), "left_anti").select(*delta.columns)
    return _joined(target, last.where(_whole(keys)), keys, columns).unionByName(fresh, allowMissingColumns=True)


def insert_if_absent(target: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The delta's rows whose key the target lacks, the first per whole key; rows with a null key all go in."""
    return _one_per_key(delta, keys, order, F.min_by).join(target.select(*keys), list(keys), "left_anti").select(*delta.columns)


def _mark(path: str, number: int) -> str:
    return f"{path}/_{BATCH}/{number}"


def replace_table(frame: DataFrame, path: str, number: int | None = None) -> None:
    """Overwrite a table that ``frame`` may read from.

    With a batch ``number`` the new table carries a mark of it, which readers don't see.
    The new table is written beside the old one and takes its name by renames; a crash between
    them leaves both whole under ``path`` + ``.next`` and ``.old``.
    """
    spark = frame.sparkSession
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + end) for end in ("", ".next", ".old")]
    system = paths[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    frame.write.mode("overwrite").parquet(path + ".next")
    if number is not None:
        system.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_mark(path + ".next", number)), True).close()
    system.delete(paths[2], True)
    if system.exists(paths[0]) and not system.rename(paths[0], paths[2]):
        raise OSError(f"cannot move {path} aside")
    if not system.rename(paths[1], paths[0]):
        raise OSError(f"cannot rename {path}.next")
    system.delete(paths[2], True)


def before_batch(target: DataFrame, number: int) -> DataFrame:
    """The table without the rows that a batch of this number wrote: a replay starts from there.

    Rows that the batch overwrote are overwritten again by the same rows, so keyed rows end
    alike, and rows with a null in a key, which conflict with nothing, aren't written twice.
    """
    return target.where(~F.col(BATCH).eqNullSafe(F.lit(number).cast("bigint"))) if BATCH in target.columns else target


def merge_buckets(delta: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int, number: int | None = None) -> None:
    """Upsert into a table partitioned by a hash of its keys: only partitions that the delta touches are rewritten.

    With a batch ``number`` the rows keep it (column ``batch``), and a replay changes nothing.
    """
    if number is not None:
        delta = delta.withColumn(BATCH, F.lit(number).cast("bigint"))
    spark = delta.sparkSession
    marked = delta.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = [r[0] for r in marked.select("bucket").distinct().collect()]  # at most ``buckets``
    if not touched:
        return
    base = spark.read.parquet(path).where(F.col("bucket").isin(touched)) if _exists(spark, path) else marked.limit(0)
    if number is not None:
        base = before_batch(base, number)
    merged = cut(upsert(base, marked, keys, order), "merged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't done yet: resume after an interruption."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def store_glossary(terms: DataFrame, path: str, replace: bool = False) -> None:
    """Upsert terms with their senses; ``replace`` wipes what was there."""
    spark = terms.sparkSession
    if not replace and _exists(spark, path):
        terms = upsert(spark.read.parquet(path), terms, ["term"], [])
    replace_table(terms, path)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def export_glossary(terms: DataFrame, path: str, least: float = 0.0, first_sense: bool = False) -> None:
    """Relevant terms by falling confidence, as JSON lines."""
    kept = terms.where(F.col("relevant") & (F.col("confidence") >= least))
    kept = kept.withColumn("senses", F.slice("senses", 1, 1)) if first_sense else kept
    kept.orderBy(F.desc("confidence"), "term").write.mode("overwrite").json(path)


def marked_csv(rows: DataFrame, path: str) -> None:
    """Semicolons, every value quoted; new lines as bars, lists joined, null as empty.

    Every part starts with a byte order mark and the header, so each opens as a table in an
    office program; an empty table is one part with a header alone.
    """
    ship(rows.sparkSession)

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))

    values = []
    for name, kind in rows.dtypes:
        value = F.array_join(F.col(f"`{name}`").cast("array<string>"), "; ") if kind.startswith("array") else F.col(f"`{name}`").cast("string")
        values.append(quoted(F.regexp_replace(F.coalesce(value, F.lit("")), r"\r?\n", " | ")))
    head = "\ufeff" + ";".join('"' + name.replace('"', '""') + '"' for name in rows.columns)

    def one(values: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([values], names=["value"])

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            if batch.num_rows and not begun:
                yield one(pa.array([head], pa.string()))
                begun = True
            yield one(batch.column(0))

    lines = rows.select(F.concat_ws(";", *values).alias("value"))
    lines.mapInArrow(headed, "value string").write.mode("overwrite").text(path)
    spark = rows.sparkSession
    if spark.read.text(path).isEmpty():
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def stage_artifacts(stages: dict[str, DataFrame], path: str) -> None:
    """One parquet folder per stage, numbered in order."""
    for i, (name, frame) in enumerate(stages.items()):
        frame.write.mode("overwrite").parquet(f"{path}/{i:02d}_{name}")


def ready_notes(label: Column, lead_type: Column, evidence: Column, notes: Column) -> Column:
    """The combined notes of a card lead."""
    warmth = F.when(lead_type == "card_seeker", "warmth").otherwise("overlap")
    return F.concat(F.lit("[confidence: "), F.coalesce(label, F.lit("low")), F.lit(" | "), warmth, F.lit('] "'), F.coalesce(evidence, F.lit("")), F.lit('" — '), F.coalesce(notes, F.lit("")))
