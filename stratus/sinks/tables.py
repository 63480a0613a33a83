"""K1-K8: exports and table loads.

Tables are Parquet folders. Loads validate first; append mode inserts only
keys not yet stored (null-safe); upsert and keyed edits replace the files that
hold rows of the keys. Every write goes to a path the caller owns (for jobs: a folder
under the cluster's shared ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratus.functions.sanitize import sanitize_frame
from stratus.functions.time import ts_to_iso
from stratus.operators.dedup import repeated_keys, same_keys
from stratus.schema import KEY_COLUMNS, UNIFIED_COLUMNS, UNIFIED_SCHEMA
from stratus.session import cut_lineage


def to_export_frame(df: DataFrame) -> DataFrame:
    """K1 preparation: 23 columns, NaN/Inf -> null, timestamp as ISO text. A
    weather code marked in ``weather_code_number`` is written as a JSON number."""
    numeric = "weather_code_number" in df.columns
    out = sanitize_frame(df.select(*UNIFIED_COLUMNS, *(["weather_code_number"] if numeric else [])))
    if numeric:
        code = F.col("weather_code")
        out = out.withColumn("weather_code", F.coalesce(F.when(F.col("weather_code_number"), F.try_parse_json(code)), code.cast("variant")))
    return out.withColumn("timestamp", ts_to_iso(F.col("timestamp"))).select(*UNIFIED_COLUMNS)


def export_jsonl(df: DataFrame, path: str, mode: str = "overwrite", order: tuple[str, ...] = ()) -> None:
    """K1: one JSON object per line, every key written (nulls included).

    With ``order`` columns, lines read in the order of part names come in that
    order: ranges of it go to tasks, which sort theirs; there is no global sort
    in one place."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    (to_export_frame(df).write.mode(mode)
     .option("ignoreNullFields", "false")
     .option("compression", "none")
     .json(path))


def write_report(facts: DataFrame, path: str, layout: list) -> None:
    """K2: a long-form report as one JSON file. The sorted lines pass through one
    writer, a line at a time; the facts themselves are computed and sorted apart."""
    from stratus.operators.quality import report_lines
    facts = cut_lineage(facts, "report")
    report_lines(facts, layout).orderBy("part", "place", "key").select("line").coalesce(1).write.mode("overwrite").text(path)


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a stored table with the unified schema."""
    return spark.read.schema(UNIFIED_SCHEMA).parquet(path)


def read_unified(spark: SparkSession, path: str) -> DataFrame:
    """S8 (typed form): read unified JSONL with declared types (fast path)."""
    text_schema = ", ".join(f"`{f.name}` {'string' if f.name == 'timestamp' else f.dataType.simpleString()}"
                            for f in UNIFIED_SCHEMA.fields)
    # a line or value that does not fit the schema is an error, not a null row
    raw = spark.read.schema(text_schema).option("mode", "FAILFAST").json(path)
    from stratus.functions.time import iso_timestamp
    return raw.withColumn("timestamp", iso_timestamp(F.col("timestamp")))


#: Bits of a place on each axis of the layout: 2**BITS ranges of stations and of times.
LAYOUT_BITS = 6


def interleaved(a, b, bits: int = LAYOUT_BITS):
    """The bits of two numbers in turn, ``a``'s first: neighbours in both stay near."""
    out = F.lit(0)
    for i in range(bits):
        for x, place in ((b, 2 * i), (a, 2 * i + 1)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(x, i).bitwiseAND(F.lit(1)), place))
    return out


def with_place(df: DataFrame, bits: int = LAYOUT_BITS) -> DataFrame:
    """Add ``_place``: a number per row that keeps rows of near stations *and* near times together.

    Both axes are cut at quantiles of the data (approximate; 2**bits - 1 numbers
    each reach the driver): stations by their first seven bytes as a number,
    which keeps their order, times by their seconds. A station or an hour with many
    rows gets as many ranges as it fills quantiles. A row's range on an axis is
    found by halving, a projection a step, so that nothing is computed twice."""
    station = F.conv(F.rpad(F.hex(F.coalesce("station_id", F.lit(""))), 14, "0"), 16, 10).cast("long")
    time = F.coalesce(F.unix_seconds(F.col("timestamp").cast("timestamp")), F.lit(0))
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(F.percentile_approx(station, shares, 100 * 2**bits).alias("s"), F.percentile_approx(time, shares, 100 * 2**bits).alias("t")).first()
    points = {axis: F.array(*(F.lit(p).cast("long") for p in at or [])).cast("array<long>") for axis, at in (("_s", cuts.s), ("_t", cuts.t))}

    # the number of points below a value: no points (an empty table) give 0
    out = df.withColumns({"_s": station, "_t": time, "_s_at": F.lit(0), "_t_at": F.lit(0)})
    for step in (2**i for i in reversed(range(bits))):
        below = lambda axis: F.get(points[axis], F.col(f"{axis}_at") + (step - 1)) < F.col(axis)  # noqa: E731, B023
        out = out.withColumns({f"{axis}_at": F.col(f"{axis}_at") + F.when(below(axis), step).otherwise(0) for axis in points})
    return out.withColumn("_place", interleaved(F.col("_s_at"), F.col("_t_at"), bits)).drop("_s", "_t", "_s_at", "_t_at")


def write_layout(df: DataFrame, path: str, mode: str = "overwrite", keep: tuple[str, ...] = ()) -> None:
    """K7: partition by source; rows go to files by the interleaved key of station
    and time (:func:`with_place`), so Parquet statistics prune files for a
    station's rows, for a time slice over all stations, and for both.

    Range partitioning samples the key distribution, so a station holding a
    large share of the rows is split over several tasks by time range instead of
    landing in one. Within files rows are sorted by station and time, for
    statistics of row groups and pages. Columns of ``keep`` are stored too.
    """
    rows = df.select(*UNIFIED_COLUMNS, *keep)
    (with_place(rows).repartitionByRange("_place", "station_id", "timestamp").drop("_place")
     # the partition column first: the writer sorts by it anyway, and keeps this order
     .sortWithinPartitions("source", "station_id", "timestamp")
     .write.mode(mode).partitionBy("source").parquet(path))


def load_overwrite(accepted: DataFrame, path: str) -> None:
    """K3: reset mode, the table becomes exactly the accepted rows."""
    write_layout(accepted, path, "overwrite")


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished folder in the place of ``target``; what was there stands
    beside it until the new one is in place, and comes back if that fails."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    a, b, old = jvm_path(source), jvm_path(target), jvm_path(f"{source}.old")
    fs = a.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(b)
    if had and not fs.rename(b, old):
        raise OSError(f"could not move {target} aside")
    if not fs.rename(a, b):
        if had:
            fs.rename(old, b)
        raise OSError(f"could not move {source} to {target}")
    fs.delete(old, True)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _existing_keys(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Stored keys, None where there is no table; a table that cannot be read is an error."""
    if path is None or not path_exists(spark, path):
        return None
    return scan_table(spark, path).select(*KEY_COLUMNS)


#: Words (64 bits) of the largest Bloom filter that is built: 1 MB.
BLOOM_WORDS = 1 << 17
BLOOM_PROBES = 4
#: Distinct stations up to which a batch names them to the scan, beyond its range.
NAMED_STATIONS = 100


def bloom_filter(keys: DataFrame, n: int, names: list[str] = KEY_COLUMNS):
    """A condition on ``names`` that holds for all ``n`` keys and few others, or
    None where the filter would pass its size limit (then a join alone decides)."""
    words = 64
    while words * 4 < n:  # 16 bits a key or more
        words *= 2
    if words > BLOOM_WORDS:
        return None
    spark = keys.sparkSession
    probes = [F.pmod(F.xxhash64(*names, F.lit(i)), F.lit(64 * words)) for i in range(BLOOM_PROBES)]
    bit = keys.select(F.explode(F.array(*probes)).alias("at")).select(F.expr("at div 64").alias("word"), F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("bits"))
    whole = bit.union(spark.range(words).select("id", F.lit(0).cast("long"))).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    held = whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words")).scalar()
    out = F.lit(True)
    for at in probes:
        word = F.get(held, F.floor(at / 64).cast("int"))
        out = out & (F.getbit(word, (at % 64).cast("int")) == 1)
    return out


def pruned_keys(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored keys that may be among those of ``batch``: within its range of
    stations and times (and its stations, where few), which the scan prunes
    files and row groups by, and in the Bloom filter of its keys."""
    ends = batch.agg(F.count(F.lit(1)).alias("n"), F.min("station_id").alias("s0"), F.max("station_id").alias("s1"),
                     F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
                     F.count_if(F.col("station_id").isNull()).alias("s_null"), F.count_if(F.col("timestamp").isNull()).alias("t_null")).first()
    named = [r[0] for r in batch.select("station_id").distinct().limit(NAMED_STATIONS + 1).collect()] if ends.n else []
    station, time = F.col("station_id"), F.col("timestamp")
    near = station.between(ends.s0, ends.s1)
    if 0 < len(named) <= NAMED_STATIONS:
        near = near & station.isin(*[s for s in named if s is not None])
    near_time = time.between(F.lit(ends.t0).cast("timestamp_ntz"), F.lit(ends.t1).cast("timestamp_ntz"))
    out = existing.filter((near | station.isNull()) if ends.s_null else near)
    out = out.filter((near_time | time.isNull()) if ends.t_null else near_time)
    member = bloom_filter(batch, ends.n)
    return out if member is None else out.filter(member)


def insert_ignore_plan(rows: DataFrame, existing: DataFrame | None, order: str = "pos",
                       valid=None) -> DataFrame:
    """K4 plan: ``duplicate`` tells rows whose key came earlier or is already
    stored. Only ``valid`` rows take part; the others go around the joins.

    The keys that are repeated or stored are stored as a table of their own,
    which the rows are joined with: Spark knows its size, and what reads the
    result twice does not search again.
    """
    ok = F.lit(True) if valid is None else valid
    able = rows.filter(ok)
    marks = repeated_keys(able, KEY_COLUMNS, order).withColumn("_stored", F.lit(False))
    if existing is not None:
        batch = cut_lineage(able.select(*KEY_COLUMNS).distinct(), "batch-keys")
        near = pruned_keys(existing, batch).select(*KEY_COLUMNS)
        taken = batch.join(near, same_keys(batch, near, KEY_COLUMNS), "left_semi")
        marks = marks.unionByName(taken.withColumn("_stored", F.lit(True)), allowMissingColumns=True)
        marks = marks.groupBy(*KEY_COLUMNS).agg(F.min("_first").alias("_first"), F.max("_stored").alias("_stored"))
    marks = cut_lineage(marks, "keys")
    tagged = able.join(marks, same_keys(able, marks, KEY_COLUMNS), "left").select(able["*"], marks["_first"], marks["_stored"])
    late = F.coalesce(F.col("_stored"), F.lit(False)) | F.coalesce(F.col(order) != F.col("_first"), F.lit(False))
    out = tagged.withColumn("duplicate", late).drop("_first", "_stored")
    return out if valid is None else out.unionByName(rows.filter(~F.coalesce(ok, F.lit(False))).withColumn("duplicate", F.lit(False)))


def upsert(target: DataFrame, updates: DataFrame, order: str = "pos") -> DataFrame:
    """K5: stored rows of untouched keys, plus the last update of every key."""
    from pyspark.sql import Window
    w = Window.partitionBy(*KEY_COLUMNS).orderBy(F.col(order).desc())
    last = (updates.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select(*target.columns))
    keys = last.select(*KEY_COLUMNS)
    cond = [target[k].eqNullSafe(keys[k]) for k in KEY_COLUMNS]
    kept = target.join(keys, cond, "left_anti").select(*target.columns)
    return kept.unionByName(last)


def update_where(df: DataFrame, predicate, assignments: dict) -> DataFrame:
    """K6: set fields on rows matching ``predicate``."""
    new = {c: v if not isinstance(v, (int, float, str)) else F.lit(v) for c, v in assignments.items()}
    # one projection: predicate and values see the row as it was
    return df.select(*[F.when(predicate, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """K6: drop rows matching ``predicate`` (null predicate keeps the row)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


class _Files:
    """The few file operations of a swap, on the file system of a table."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def of_uri(self, uri: str) -> str:
        return self.hadoop.Path(self.jvm.java.net.URI(uri)).toString()

    def below(self, folder: str) -> list[str]:
        """Data files below ``folder``, as paths relative to it."""
        root = self.fs.makeQualified(self.hadoop.Path(folder)).toString()
        found, out = self.fs.listFiles(self.hadoop.Path(folder), True), []
        while found.hasNext():
            path = found.next().getPath()
            if not path.getName().startswith(("_", ".")):
                out.append(path.toString()[len(root) + 1:])
        return out

    def journals(self) -> list[str]:
        status = self.fs.globStatus(self.hadoop.Path(f"{self.path}/_swap-*.json")) or []
        return [x.getPath().toString() for x in status]

    def write(self, path: str, text: str) -> None:
        aside = self.hadoop.Path(f"{path}.tmp")
        out = self.fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.fs.rename(aside, self.hadoop.Path(path)):
            raise OSError(f"could not write {path}")

    def read(self, path: str) -> str:
        source = self.fs.open(self.hadoop.Path(path))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def move(self, source: str, target: str) -> None:
        target = self.hadoop.Path(target)
        if self.fs.exists(target):
            return  # an earlier try came as far
        self.fs.mkdirs(target.getParent())
        if not self.fs.rename(self.hadoop.Path(source), target):
            raise OSError(f"could not move {source}")

    def delete(self, path: str) -> None:
        self.fs.delete(self.hadoop.Path(path), True)


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Carry out the swaps of files that a journal in the table names, from
    wherever an interrupted edit left them. Running it again changes nothing."""
    files = _Files(spark, path)
    for journal in files.journals():
        swap = json.loads(files.read(journal))
        for name in swap["add"]:
            files.move(f"{swap['staged']}/{name}", f"{path}/{name}")
        for name in swap["remove"]:
            files.delete(name)
        files.delete(swap["staged"])
        files.delete(journal)


def _rewrite_files(spark: SparkSession, path: str, touched: DataFrame, change, more: bool = False) -> None:
    """Replace the files named in ``touched`` (column ``_file``) by ``change`` of
    their rows; other files are neither read nor written.

    The new files are written into a hidden folder of the table first; a journal
    then names what is added and removed, and is followed. A failure before the
    journal leaves the table as it was; :func:`finish_swaps` ends a swap that
    stopped behind it. ``more``: rows may be added without a touched file.
    """
    files = _Files(spark, path)
    finish_swaps(spark, path)
    old = [files.of_uri(r[0]) for r in touched.select("_file").distinct().collect()]  # names of files, as a listing
    if not old and not more:
        return
    reader = spark.read.schema(UNIFIED_SCHEMA).option("basePath", path)
    rows = reader.parquet(*old) if old else spark.createDataFrame([], UNIFIED_SCHEMA)
    new = cut_lineage(change(rows.select(*UNIFIED_COLUMNS)).select(*UNIFIED_COLUMNS), "rewrite")
    name = uuid.uuid4().hex[:12]
    staged = f"{path}/_staged-{name}"
    write_layout(new, staged)
    swap = {"staged": staged, "add": files.below(staged), "remove": old}
    files.write(f"{path}/_swap-{name}.json", json.dumps(swap))
    finish_swaps(spark, path)


def _with_file(spark: SparkSession, path: str) -> DataFrame:
    return scan_table(spark, path).withColumn("_file", F.col("_metadata.file_path"))


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, order: str = "pos") -> None:
    """K5 on a stored table: :func:`upsert`, rewriting only the files that hold
    an updated key; the updates themselves are new files. Files that cannot hold
    a key by their statistics are not read (:func:`pruned_keys`)."""
    finish_swaps(spark, path)
    keys = cut_lineage(updates.select(*KEY_COLUMNS).distinct(), "batch-keys")
    if keys.isEmpty():
        return
    target = pruned_keys(_with_file(spark, path), keys)
    touched = target.join(keys, same_keys(target, keys, KEY_COLUMNS), "left_semi")
    _rewrite_files(spark, path, touched, lambda rows: upsert(rows, updates, order), more=True)


def update_table(spark: SparkSession, path: str, predicate, assignments: dict) -> None:
    """K6 on a stored table: :func:`update_where`, rewriting the files of matching rows."""
    finish_swaps(spark, path)
    _rewrite_files(spark, path, _with_file(spark, path).filter(predicate), lambda rows: update_where(rows, predicate, assignments))


def delete_from_table(spark: SparkSession, path: str, predicate) -> None:
    """K6 on a stored table: :func:`delete_where`, rewriting the files of matching rows."""
    finish_swaps(spark, path)
    _rewrite_files(spark, path, _with_file(spark, path).filter(predicate), lambda rows: delete_where(rows, predicate))
