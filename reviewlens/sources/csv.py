"""CSV scans: header, doubled quotes, line breaks inside quoted fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.sources import files

QUOTE = '"'
_QUOTED = r'"(?:[^"]|"")*+'
_FIELD = rf'(?:{_QUOTED}"|[^",\r]*+)'
_FIELDS = rf'(?:{_FIELD},)*+(?:{_FIELD}|{_QUOTED})'
#: A line that begins a record: fields, the last of which may stay open.
_OUTSIDE = rf'^{_FIELDS}$'
#: A line that begins inside a field: the rest of the field, then as above.
_INSIDE = rf'^(?:[^"]|"")*+(?:"(?:|,{_FIELDS}))?$'
#: An odd run of quotes: where a quoted field ends, since pairs of quotes stand for one.
_ODD_RUN = r'(?<!")"(?:"")*+(?!")'
#: The same with a line feed behind it.
_FEED_AFTER = rf"(?s){_ODD_RUN}.*\n"
#: What `from_csv` takes for the end of a record, as a line break is text to it.
RECORD_END = "\uffff"
OPTIONS = {"header": True, "quote": QUOTE, "escape": QUOTE}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    missing: str = "raise",
) -> DataFrame:
    """CSV table with quoted line breaks, read by Spark's own reader: a task per file.

    Spark cannot split a file whose fields contain line breaks, so many files
    are the unit of parallel work; see :func:`read_csv_in_parallel` for large
    ones.  Each file is matched by its own header: files with different headers
    are read apart, each held against the schema, and united by name.  Without a
    schema the types are inferred, which reads the data twice.  See
    :func:`with_schema` for how columns meet a schema.
    """
    reader = spark.read.options(**OPTIONS, multiLine=True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    parts = [reader.csv(paths) for paths, _ in _by_header(spark, path)]
    if schema is not None:
        parts = [with_schema(part, schema, missing) for part in parts]
    return _united(parts)


def _united(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _by_header(spark: SparkSession, path: str | list[str]) -> list[tuple[list[str], str]]:
    """Files with the same first line and line end; one that opens a quoted line break is alone."""
    paths = [path] if isinstance(path, str) else list(path)
    found = [f for p in paths for f in files.text_files(spark, p)]
    groups: dict[tuple[str, str], list[str]] = {}
    for name, (line, end) in zip(found, files.first_lines(spark, found)):
        groups.setdefault((name if line.count(QUOTE) % 2 else line, end), []).append(name)
    return [(names, end) for (_, end), names in groups.items()] or [(paths, "\n")]


def _value(text: Column, kind: T.DataType) -> Column:
    """Typed value; a whole number may be written with a decimal point."""
    value = text.try_cast(kind)
    if isinstance(kind, T.LongType):
        value = F.coalesce(value, text.try_cast("double").try_cast(kind))
    return value


def with_schema(named: DataFrame, schema: T.StructType, missing: str = "raise") -> DataFrame:
    """Text columns cast to the schema by name, whatever the case of the header.

    Unusable values are null.  Columns that the schema does not declare follow
    as text.  A declared column that the file lacks raises an error, or is null
    when ``missing`` is ``"null"``.
    """
    present: dict[str, str] = {}
    for name in named.columns:
        if name.lower() in present:
            raise ValueError(f"two columns are called {name!r} but for case")
        present[name.lower()] = name
    absent = [f.name for f in schema.fields if f.name.lower() not in present]
    if absent and missing != "null":
        raise ValueError(f"the file has no column {', '.join(absent)}; it has {', '.join(named.columns)}")
    declared = {f.name.lower() for f in schema.fields}
    typed = [
        (
            _value(F.col(f"`{present[f.name.lower()]}`"), f.dataType)
            if f.name.lower() in present
            else F.lit(None).cast(f.dataType)
        ).alias(f.name)
        for f in schema.fields
    ]
    others = [F.col(f"`{name}`") for key, name in present.items() if key not in declared]
    return named.select(*typed, *others)


def read_csv_in_parallel(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    missing: str = "raise",
    strict: bool = True,
) -> DataFrame:
    """The same rows as :func:`read_csv`, with large files read by many tasks.

    ``strict`` takes files that quote as RFC 4180 says: a field with a quote, a
    comma or a line break is quoted and its quotes are doubled.  A line that
    breaks the rule, or a lone carriage return as line end, raises an error, as do
    files with different headers.  With ``strict=False`` any file is read, by the
    rules of Spark's reader: a quote opens a field only at its start, a quoted
    field ends at a quote that is not doubled, and whatever follows up to the next
    comma or line end is text.

    The text is read by splittable lines.  What a line does is a small function,
    from whether it starts inside a quoted field to whether it ends inside one.
    Such functions combine in any grouping, so the state before a line is that of
    the lines before it in its block of the file, after that of the blocks before.
    Only a row per block is put in order for a file.  Lines of one record are joined
    again and parsed by Spark's own CSV parser.  The first line end of a file says
    what ends its lines, as in Spark's reader: LF, CR LF or CR.  Where that is not LF,
    a lone LF belongs into quotes; outside them Spark's reader takes it now for text
    and now for a line end, so it raises an error here.
    """
    groups = _by_header(spark, path)
    if strict and len(groups) > 1:
        raise ValueError("the files have different headers; read them with read_csv")
    if strict and groups[0][1] == "\r":
        raise ValueError("not strictly quoted CSV, use read_csv: a carriage return ends a line")
    return _united([with_schema(_parsed(spark, paths, end, strict), schema, missing) for paths, end in groups])


def _lines(spark: SparkSession, paths: list[str], end: str) -> DataFrame:
    """``file, block, line, value``: the lines of each block of a file, numbered in order."""
    located = spark.read.option("lineSep", end).text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return located.withColumn("line", F.monotonically_increasing_id())


def _quote_effect(value: Column, feeds: bool) -> Column:
    """Whether a line ends inside a quoted field: ``outside``, ``inside`` by where it starts.

    Between two commas only two things count: whether the piece opens a field that it
    does not close, and whether it leaves an open field open.  With ``feeds`` also
    whether a line feed stands outside quotes, ``feed_outside`` and ``feed_inside``.
    """

    def piece(p: Column) -> Column:
        quoted, rest = F.startswith(p, F.lit(QUOTE)), F.substr(p, F.lit(2))
        found = [(quoted & ~rest.rlike(_ODD_RUN)).alias("opens"), (~p.rlike(_ODD_RUN)).alias("stays")]
        if feeds:
            plain = ~quoted & F.contains(p, F.lit("\n"))
            found.append((plain | quoted & rest.rlike(_FEED_AFTER)).alias("feed_outside"))
            found.append(p.rlike(_FEED_AFTER).alias("feed_inside"))
        return F.struct(*found)

    def step(state: Column, p: Column) -> Column:
        out = [F.when(state[n], p["stays"]).otherwise(p["opens"]).alias(n) for n in ("outside", "inside")]
        for n in ("outside", "inside") if feeds else ():
            here = F.when(state[n], p["feed_inside"]).otherwise(p["feed_outside"])
            out.append((state[f"feed_{n}"] | here).alias(f"feed_{n}"))
        return F.struct(*out)

    start = [F.lit(False).alias("outside"), F.lit(True).alias("inside")]
    idle = F.struct(*start)
    if feeds:
        idle = F.struct(*start, F.contains(value, F.lit("\n")).alias("feed_outside"), F.lit(False).alias("feed_inside"))
        start += [F.lit(False).alias("feed_outside"), F.lit(False).alias("feed_inside")]
    pieces = F.transform(F.split(value, ","), piece)
    folded = F.aggregate(pieces, F.struct(*start), step)
    return F.when(F.contains(value, F.lit(QUOTE)), folded).otherwise(idle)


def _with_state(df: DataFrame, by: list[str], order: str, effect: str, state: str) -> DataFrame:
    """Adds what all earlier rows of the group do, as such a function, in column ``state``.

    A row leaves the state, turns it round, or sets it.  After the last row that sets
    it, only the parity of the turns counts.
    """
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outside, inside = F.col(f"{effect}.outside"), F.col(f"{effect}.inside")
    turns = F.coalesce(F.sum((outside & ~inside).cast("int")).over(earlier), F.lit(0)) % 2 == 1
    sets = F.when(outside == inside, F.struct(F.col(order), (outside != F.col("_turned")).alias("value")))
    fixed = F.col("_set.value") != F.col("_turned")
    after = lambda start: F.coalesce(fixed, F.lit(start) != F.col("_turned"))
    return (
        df.withColumn("_turned", turns)
        .withColumn("_set", F.max(sets).over(earlier))
        .withColumn(state, F.struct(after(False).alias("outside"), after(True).alias("inside")))
        .drop("_turned", "_set")
    )


def _applied(effect: str, start: Column, name: str = "") -> Column:
    return F.when(start, F.col(f"{effect}.{name}inside")).otherwise(F.col(f"{effect}.{name}outside"))


def _parsed(spark: SparkSession, paths: list[str], end: str, strict: bool) -> DataFrame:
    """All columns of files with one header, as text."""
    header = spark.read.options(**OPTIONS, multiLine=True).csv(paths[0]).columns
    lines = _lines(spark, paths, end).withColumn("effect", _quote_effect(F.col("value"), end != "\n"))
    in_block = Window.partitionBy("file", "block").orderBy("line")
    lines = _with_state(lines, ["file", "block"], "line", "effect", "before_line")

    # One row per block of a file: what the block does, and the state before it.
    whole = F.struct(
        *[_applied("effect", F.col(f"before_line.{n}")).alias(n) for n in ("outside", "inside")]
    )
    blocks = lines.groupBy("file", "block").agg(F.max_by(whole, "line").alias("effect"))
    blocks = _with_state(blocks, ["file"], "block", "effect", "before_block")
    blocks = blocks.select("file", "block", F.col("before_block.outside").alias("opens_inside"))
    marked = lines.join(blocks, ["file", "block"]).withColumn(
        "starts", ~_applied("before_line", F.col("opens_inside"))
    )
    # Checked where a line is used, so a file that breaks a rule gives no rows at all.
    if end != "\n":
        complaint = F.concat(F.lit("a line feed outside quotes, use read_csv: "), F.substring("value", 1, 200))
        feed = _applied("effect", ~F.col("starts"), "feed_")
        marked = marked.withColumn("value", F.when(~feed, F.col("value")).otherwise(F.raise_error(complaint)))
    if strict:
        fits = F.when(F.col("starts"), F.col("value").rlike(_OUTSIDE)).otherwise(F.col("value").rlike(_INSIDE))
        complaint = F.concat(F.lit("not strictly quoted CSV, use read_csv: "), F.substring("value", 1, 200))
        marked = marked.withColumn("value", F.when(fits, F.col("value")).otherwise(F.raise_error(complaint)))

    # The record of a line is the latest starting line of its block.
    numbered = (
        marked.withColumn("record", F.max(F.when(F.col("starts"), F.col("line"))).over(in_block))
        .withColumn(
            "is_header",
            (F.col("block") == 0)
            & F.coalesce(F.col("record") == F.first("line").over(in_block), F.lit(False)),
        )
        .withColumn(
            "alone", F.col("starts") & F.coalesce(F.lead("starts").over(in_block), F.lit(False))
        )
    )

    # Lines before the first start of a block finish a record of an earlier block.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_records = (
        numbered.groupBy("file", "block")
        .agg(F.max("record").alias("last_record"))
        .select(
            "file", "block", F.last("last_record", ignorenulls=True).over(before).alias("open")
        )
    )
    body = numbered.filter(~F.col("is_header")).withColumn(
        "stays_open", _applied("effect", ~F.col("starts"))
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined_lines = (
        body.filter(~F.col("alone"))
        .join(open_records, ["file", "block"])
        .groupBy("file", F.coalesce("record", "open").alias("record"))
        .agg(
            F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("text"),
            F.max_by("stays_open", F.struct("block", "line")).alias("stays_open"),
        )
        .select("text", "stays_open")
    )
    # Nearly every record is one line and needs no second shuffle.
    alone = body.filter("alone").select(F.col("value").alias("text"), F.lit(False).alias("stays_open"))
    records = alone.unionByName(joined_lines).filter(F.col("text") != "")
    # The parser sees the line end that the record has, or the end of the file in an open field.
    text = F.when(F.col("stays_open"), F.col("text")).otherwise(F.concat("text", F.lit(RECORD_END)))
    columns = ", ".join(f"`{name}` STRING" for name in header)
    return records.select(F.from_csv(text, columns, {"quote": QUOTE, "escape": QUOTE}).alias("row")).select("row.*")
