"""Small helpers shared by the text operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: A Python task works on so many characters of text at a time, whatever the Arrow batch holds.
SLICE_CHARS = 4_000_000
#: Lists of ids are broadcast up to so many, counted; longer ones are shuffled.
BROADCAST_IDS = 1_000_000
#: Classes that hold more than this share of the rows, and more than HOT_LEAST, are few and go by broadcast.
HOT_CLASSES = 500
HOT_LEAST = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test-data folder, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the checkpoint folder set, or spark.checkpoint.dir. Local masters may do with a temporary one."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return folder or tempfile.mkdtemp(prefix="stratus-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def texts_of(column: pa.Array) -> list:
    """The texts of an Arrow column; bytes that are no UTF-8 count as U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        raw = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()
        return [None if b is None else b.decode("utf-8", "replace") for b in raw]


def least_hashes(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """At most bound distinct rows, those of the least hashes of their key; ties go by the columns in order.

    The sort of a limit ends in one task, to which every partition sends its share. So a cut on the hash, drawn from the row count, is
    put first: some four times the bound pass it, whatever the size; should too few distinct rows pass, all are sorted.
    """
    n = rows.count()
    if n > 8 * bound:
        below = rows.where(F.xxhash64(key) < F.lit(-(1 << 63) + (1 << 64) * 4 * bound // n)).distinct()
        rows = below if below.count() >= bound else rows
    return rows.distinct().orderBy(F.xxhash64(key), *rows.columns).limit(bound)


def least_hashes_of_each(rows: DataFrame, key: str, by: str, bound: int) -> DataFrame:
    """At most bound distinct rows, shared evenly between the values of `by` (at least one each): of each the least hashes of the key.

    `by` has few values, each brings one row to the driver. As in least_hashes(), a cut on the hash goes first for each large value.
    """
    sizes = {r[by]: r["n"] for r in rows.groupBy(by).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return rows.limit(0)
    each = max(1, bound // len(sizes))
    cuts = [(v, -(1 << 63) + (1 << 64) * 4 * each // n if n > 8 * each else (1 << 63) - 1) for v, n in sizes.items()]
    cut = rows.sparkSession.createDataFrame(cuts, StructType([rows.schema[by], StructField("__cut", LongType())]))
    hashed = F.xxhash64(key)

    def least(of: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(by).orderBy(hashed, *rows.columns))
        return of.withColumn("__n", place).where(F.col("__n") <= each).drop("__n")

    below = rows.join(F.broadcast(cut), by).where(hashed <= F.col("__cut")).select(*rows.columns).distinct()
    got = {r[by]: r["n"] for r in below.groupBy(by).agg(F.count("*").alias("n")).collect()}
    # Many repeated rows may leave too few below the cut; then all distinct rows are sorted.
    short = any(n > 8 * each and got.get(v, 0) < each for v, n in sizes.items())
    return least(rows.distinct() if short else below)


def row_hash(docs: DataFrame):
    """A hash of all columns; nulls are told from what stands beside them."""
    return F.xxhash64(*[F.col(c) for c in docs.columns], *[F.col(c).isNull() for c in docs.columns])


def least_row():
    """The order of (doc_id, row) by which a row of a group is chosen: least key, keys before null, then the row's hash."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")


def one_row_of_each_group(docs: DataFrame, rows: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """The least row of each group of classes, with all its columns; of rows alike in every column one.

    rows: doc_id, row (row_hash()), class of each row; classes: class, best (the least by least_row()), row (best's); roots: node, root of classes that link.
    """
    linked = classes.join(roots.withColumnRenamed("node", "class"), "class").select("class", "best", "root")
    moved = linked.join(linked.groupBy("root").agg(F.min("best").alias("kept")), "root").select("class", "kept")
    kept = classes.join(moved, "class", "left").select("class", F.coalesce("kept.row", "row").alias("kept"))
    # A text held by many rows is one class: rows are counted before they meet their class, and the few classes with a HOT_CLASSES-th of all rows meet theirs by broadcast.
    counted = cut_lineage(rows.groupBy("class", "row").agg(F.count("*").alias("n")))
    many = counted.groupBy("class").agg(F.count("*").alias("rows")).where(F.col("rows") > max(HOT_LEAST, counted.count() // HOT_CLASSES)).select("class")
    many = F.broadcast(cut_lineage(many))
    placed = counted.join(F.broadcast(kept.join(many, "class")), "class").unionByName(counted.join(many, "class", "left_anti").join(kept, "class"))
    held = cut_lineage(placed.where("n > 1 or row <> kept").select(F.col("row").alias("__row"), (F.col("row") != F.col("kept")).alias("surplus")))

    own = unused(docs, "__row")

    def listed(of: DataFrame) -> DataFrame:
        of = of.select(F.col("__row").alias(own)).distinct()
        return F.broadcast(of) if of.count() <= BROADCAST_IDS else of.hint("shuffle_hash")

    hashed = docs.withColumn(own, row_hash(docs))
    single = hashed.join(listed(held), own, "left_anti")
    repeated = hashed.join(listed(held.where("not surplus")), own, "left_semi").dropDuplicates()
    return single.unionByName(repeated).select(*docs.columns)


def unused(df: DataFrame, name: str) -> str:
    """The name, made longer until no column has it (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about SLICE_CHARS characters each; a longer text stands alone and whole."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > SLICE_CHARS:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def parts_of(batch: pa.RecordBatch, *columns: int, most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """A batch in slices with about `most` bytes in the columns named (texts or binaries), cut before anything becomes a Python object; a longer row stands alone."""
    held = np.zeros(batch.num_rows, dtype=np.int64)
    for at in columns:
        held += pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(held)
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def map_texts(docs: DataFrame, id_col: str, text_col: str, schema: str, work: Callable[[list, list], dict]) -> DataFrame:
    """Apply work(ids, texts) -> columns over Arrow batches of (id, text); other columns are dropped first.

    work is called with slices of bounded size and returns a dict that follows the schema.
    """
    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = pa.schema([(f.name, _arrow(f.dataType.simpleString())) for f in _schema(schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            for a, b in slices(texts):
                got = work(ids[a:b], texts[a:b])
                yield pa.record_batch([pa.array(got[f.name], type=f.type) for f in out], schema=out)

    return cols.mapInArrow(run, schema)


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def _arrow(name: str) -> pa.DataType:
    plain = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32()}
    if name in plain:
        return plain[name]
    if name.startswith("array<"):
        return pa.list_(_arrow(name[6:-1]))
    raise TypeError(f"no Arrow type for {name}")
