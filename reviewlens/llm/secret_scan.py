"""Secret scan with a battery of randomness tests; Spark functions only.

Three patterns give the base spans.  Besides, every run of 20 or more encoding
characters is a candidate: its encoding is inferred (hex, base32, base64), its
characters become numbers, and three tests ask whether they could be random:

* chi-squared of the character classes (equal slices of the alphabet for hex and
  base32; upper, lower, digit, symbol for base64) against uniform characters;
* the runs test above and below the middle of the alphabet;
* the serial correlation of neighbours.

Fisher's method combines the three p values.  Within each encoding and length class
the Benjamini-Hochberg rule at ``RATE`` rejects "random" from the p values of all
candidates of all documents (counted in bins of a hundredth of a decade); those are
text.

What is left is reported only if "text" is rejected as well.  Text is described by how
often a letter follows another (a-z, a digit, anything else), one half from all
documents outside the candidates, the other from lists of common words, so that there
is a description for any corpus and no narrow one.  The mean logarithm of a candidate's
pairs is compared with its mean in text; its variance is that of independent pairs
``DEPENDENCE`` times, as neighbouring pairs depend on each other, plus ``SPREAD``
squared, by which names and paths differ from running text.  The Benjamini-Hochberg
rule on these p values, again by encoding and length class, bounds the share of text
among the reported spans of kind ``random``.

Where base spans cover a part
of a candidate, each stretch of 20 or more characters outside them is a candidate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.store import stored

ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Least characters of a candidate.
LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST},}}"
#: Least characters of group 2 of an assignment.
ASSIGN_VALUE = 6
#: Upper ends of the length classes.
CLASSES = (32, 40, 64, 128, 512)
RATE = 0.05
#: Variance of a mean over pairs of text, in variances of independent pairs.
DEPENDENCE = 2.0
#: Standard deviation between strings of text, beyond chance, of that mean.
SPREAD = 0.7
KINDS = ("assign", "access", "hex", "random")
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {"hex": DIGITS + "abcdef", "base32": UPPER + "234567", "base64": UPPER + LOWER + DIGITS + "+/"}
#: Widths of the chi-squared classes along each alphabet.
WIDTHS = {"hex": (4,) * 4, "base32": (8,) * 4, "base64": (26, 26, 10, 2)}
BINS = 100
#: Matches whose lengths are summed at once.
RUN = 64
#: Letters, digits (as 0) and all other characters (as _) of the description of text.
LETTERS = LOWER + "0_"
#: Languages whose common words are a part of that description.
PRIOR_LANGUAGES = ("english", "german", "spanish", "french")


def _found(text: Column, pattern: str) -> Column:
    """Matches and the lengths of the text between them, from which places follow."""
    return F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
    )


def _spans(found: str) -> Column:
    """Array of (start, end, value) in code points.

    A start is the sum of the lengths before it.  Sums are kept for runs of ``RUN``
    matches, so the work grows as the matches, and only for the runs as their square.
    """
    add = "(a, x) -> a + x"
    steps = f"zip_with({found}.matches, slice({found}.gaps, 1, size({found}.matches)), (m, g) -> g + length(m))"
    given = f"array(named_struct('m', {found}.matches, 'g', {found}.gaps, 'steps', {steps}))"
    runs = f"if(size(v.m) = 0, cast(array() as array<int>), sequence(0, cast((size(v.m) - 1) DIV {RUN} as int)))"
    sums = f"transform({runs}, b -> aggregate(slice(v.steps, {RUN} * b + 1, {RUN}), 0, {add}))"
    before = f"aggregate(slice(w.sums, 1, b), 0, {add}) + aggregate(slice(w.v.steps, {RUN} * b + 1, i), 0, {add})"
    one = f"""named_struct('start', {before} + element_at(w.v.g, {RUN} * b + i + 1),
                           'value', element_at(w.v.m, {RUN} * b + i + 1))"""
    inside = f"transform(sequence(0, least({RUN}, size(w.v.m) - {RUN} * b) - 1), i -> {one})"
    placed = f"flatten(transform(sequence(0, size(w.sums) - 1), b -> {inside}))"
    empty = "cast(array() as array<struct<start:int,value:string>>)"
    # arrays of one element bind what all matches share
    bound = f"""flatten(transform({given}, v -> flatten(transform(
                  array(named_struct('v', v, 'sums', {sums})), w -> if(size(w.sums) = 0, {empty}, {placed})))))"""
    return F.expr(
        f"""transform({bound}, s -> named_struct(
              'start', s.start, 'end', s.start + length(s.value), 'value', s.value))"""
    )


def _outside(found: str, base: str) -> Column:
    """The stretches of each found span, ``LEAST`` characters or longer, that no base span covers.

    ``base`` is sorted by start; its spans may overlap each other.
    """
    return F.expr(
        f"""flatten(transform({found}, s -> filter(
              aggregate(
                filter({base}, b -> b.start < s.end and s.start < b.end),
                named_struct('at', s.start, 'out', cast(array() as array<struct<start:int,end:int,value:string>>)),
                (a, b) -> named_struct('at', greatest(a.at, b.end), 'out', if(b.start <= a.at, a.out,
                  concat(a.out, array(named_struct('start', a.at, 'end', b.start,
                    'value', substring(s.value, a.at - s.start + 1, b.start - a.at)))))),
                a -> if(a.at >= s.end, a.out,
                  concat(a.out, array(named_struct('start', a.at, 'end', s.end,
                    'value', substring(s.value, a.at - s.start + 1, s.end - a.at)))))),
              x -> x.end - x.start >= {LEAST})))"""
    )


def _normal_upper(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic form, within 0.0002)."""
    return 1 / (1 + F.exp(F.least(F.lit(600.0), 1.5976 * z + 0.07056 * z * z * z)))


def _chi_upper(x: Column, df: int) -> Column:
    """Upper tail of chi-squared by Wilson and Hilferty."""
    spread = 2 / (9 * df)
    return _normal_upper((F.pow(x / df, F.lit(1 / 3)) - (1 - spread)) / math.sqrt(spread))


def _two_sided(z: Column) -> Column:
    return 2 * _normal_upper(F.abs(z))


def encoding(value: Column) -> Column:
    """The narrowest encoding whose characters the value has."""
    return (
        F.when(value.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(value.rlike("^[A-Z2-7]+$"), "base32")
        .otherwise("base64")
    )


def numbers(value: Column, name: Column) -> Column:
    """Place of each character in its alphabet; URL-safe signs count as the plain ones."""
    plain = F.translate(F.when(name == "hex", F.lower(value)).otherwise(value), "-_", "+/")
    letters = F.filter(F.split(plain, ""), lambda c: c != "")

    def place(letter):
        out = F.lit(0)
        for key, alphabet in ALPHABETS.items():
            out = F.when(name == key, F.instr(F.lit(alphabet), letter) - 1).otherwise(out)
        return out

    return F.transform(letters, place)


def _between(low: int, high: int):
    return lambda v: (v >= low) & (v < high)


def _of_kind(number: int):
    return lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["value"].alias("value")
    )


def battery(candidates: DataFrame) -> DataFrame:
    """Adds ``p``, the combined p value of "random", to rows with ``value``."""
    rows = candidates.withColumn("encoding", encoding(F.col("value")))
    rows = rows.withColumn("x", numbers(F.col("value"), F.col("encoding"))).withColumn("n", F.size("x"))
    chi = F.lit(1.0)
    for name, widths in WIDTHS.items():
        size, total, low = sum(widths), F.lit(0.0), 0
        for width in widths:
            seen = F.size(F.filter("x", _between(low, low + width)))
            expected = F.col("n") * (width / size)
            total, low = total + F.pow(seen - expected, F.lit(2)) / expected, low + width
        chi = F.when(F.col("encoding") == name, _chi_upper(total, len(widths) - 1)).otherwise(chi)
    middle = F.when(F.col("encoding") == "hex", 8).when(F.col("encoding") == "base32", 16).otherwise(32)
    rows = rows.withColumn("chi", chi).withColumn("middle", middle)
    add = lambda a, b: a + b
    rows = rows.withColumn("mean", F.aggregate("x", F.lit(0.0), add) / F.col("n"))
    rows = rows.withColumn("above", F.size(F.filter("x", lambda v: v >= F.col("middle"))))
    here, after = F.slice("x", F.lit(1), F.col("n") - 1), F.slice("x", F.lit(2), F.col("n") - 1)
    changes = F.zip_with(here, after, lambda a, b: ((a >= F.col("middle")) != (b >= F.col("middle"))).cast("int"))
    products = F.zip_with(here, after, lambda a, b: (a - F.col("mean")) * (b - F.col("mean")))
    squares = F.transform("x", lambda v: (v - F.col("mean")) * (v - F.col("mean")))
    rows = (
        rows.withColumn("runs", 1 + F.aggregate(changes, F.lit(0), add))
        .withColumn("around", F.aggregate(products, F.lit(0.0), add))
        .withColumn("spread", F.aggregate(squares, F.lit(0.0), add))
    )
    n, high = F.col("n"), F.col("above")
    expected = 2.0 * high * (n - high) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    runs = F.when(variance > 0, _two_sided((F.col("runs") - expected) / F.sqrt(variance))).otherwise(0.0)
    serial = F.when(
        F.col("spread") > 0, _two_sided((F.col("around") / F.col("spread") + 1 / n) * F.sqrt(n))
    ).otherwise(0.0)
    least = lambda p: F.greatest(F.lit(1e-100), p)
    half = -(F.ln(least(F.col("chi"))) + F.ln(least(runs)) + F.ln(least(serial)))
    p = F.exp(-half) * (1 + half + half * half / 2)  # chi-squared with six degrees of freedom
    return rows.withColumn("p", F.least(F.lit(1.0), p)).drop(
        "x", "chi", "middle", "mean", "above", "runs", "around", "spread"
    )


def length_class(n: Column) -> Column:
    out = F.lit(len(CLASSES))
    for k in reversed(range(len(CLASSES))):
        out = F.when(n < CLASSES[k], k).otherwise(out)
    return out


def letter_pairs(value: Column) -> Column:
    """Neighbouring characters, as two of ``LETTERS`` each."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(value), "[0-9]", "0"), "[^a-z0]+", "_")
    return F.regexp_extract_all(plain, F.lit("(?=(..))"), F.lit(1))


def pair_logs(texts: DataFrame) -> tuple[list[float], float, float]:
    """Log probability of the second character of each pair of ``LETTERS`` after the
    first, and their mean and variance in text.

    Half of the weight have the pairs of the column ``text`` outside candidates, counted
    over all rows, half those of Spark's lists of common words; mean and variance are
    those of the less predictable of the two.  At most a row per pair of letters reaches
    the driver.
    """
    spark = texts.sparkSession
    lists = spark.sparkContext._jvm.org.apache.spark.ml.feature.StopWordsRemover
    common = [(f" {w} ",) for name in PRIOR_LANGUAGES for w in lists.loadDefaultStopWords(name)]
    outside = texts.select(F.regexp_replace("text", CANDIDATE, " ").alias("text"))
    prior, own = (
        {
            r["pair"]: r["n"]
            for r in df.select(F.explode(letter_pairs(F.col("text"))).alias("pair"))
            .groupBy("pair").agg(F.count("*").alias("n")).collect()
        }
        for df in (spark.createDataFrame(common, "text string"), outside)
    )
    both = {pair: prior.get(pair, 0) + own.get(pair, 0) for pair in {*prior, *own}}
    shares = [_after(both), _after(prior)]
    logs = [math.log((x + y) / 2) for x, y in zip(*shares)]
    described = []
    for counts in (own, prior):
        weights = [counts.get(a + b, 0) for a in LETTERS for b in LETTERS]
        if total := sum(weights):
            mean = sum(w * x for w, x in zip(weights, logs)) / total
            described.append((mean, sum(w * (x - mean) ** 2 for w, x in zip(weights, logs)) / total))
    return logs, *min(described)


def _after(counts: dict[str, int]) -> list[float]:
    """Share of the second letter after the first, each pair counted once more."""
    out = []
    for a in LETTERS:
        row = [counts.get(a + b, 0) + 1 for b in LETTERS]
        out += [n / sum(row) for n in row]
    return out


def text_p(value: Column, described: tuple[list[float], float, float]) -> Column:
    """P value of "text": the lower tail of the mean log probability of a value's pairs."""
    logs, mean, variance = described
    table, letters = F.array(*map(F.lit, logs)), F.lit(LETTERS)
    place = lambda p, k: F.instr(letters, F.substring(p, k, 1))
    known = F.transform(
        letter_pairs(value), lambda p: F.element_at(table, (place(p, 1) - 1) * len(LETTERS) + place(p, 2))
    )
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    n = F.greatest(F.lit(1), F.size(known))
    return _normal_upper((F.lit(mean) - total / n) / F.sqrt(DEPENDENCE * variance / n + SPREAD * SPREAD))


def limits(tested: DataFrame, rate: float = RATE, bin_: str = "bin", name: str = "limit") -> DataFrame:
    """Benjamini-Hochberg bin of each stratum: candidates in it or a smaller-p bin are rejected.

    A stratum is an encoding and a length class, so the result and every window
    here have a bounded number of rows whatever the number of candidates.
    """
    counts = tested.groupBy("encoding", "class", bin_).count()
    stratum = Window.partitionBy("encoding", "class")
    upto = F.sum("count").over(stratum.orderBy(F.desc(bin_)))
    total = F.sum("count").over(stratum)
    largest_p = F.pow(F.lit(10.0), -F.col(bin_) / BINS)
    return (
        counts.withColumn("upto", upto)
        .withColumn("total", total)
        .where(largest_p <= rate * F.col("upto") / F.col("total"))
        .groupBy("encoding", "class")
        .agg(F.min(bin_).alias(name))
    )


def find_spans(documents: DataFrame, doc: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """One row per document: ``doc_id, spans`` (array of start, kind number, end, value).

    Spans are sorted by start, then kind.  A null text is empty and has none.
    Repeated rows get equal spans; their candidates count as often in the
    false-discovery rules.  An empty table gives no rows.  Other columns are
    ignored.  The texts are read for the spans and for the letter pairs; what the
    tests need is stored.
    """
    rows = documents.select(
        F.col(doc).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    described = pair_logs(rows)
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": CANDIDATE}
    rows = rows.select("doc_id", *[_found(F.col("text"), p).alias(f"f_{k}") for k, p in patterns.items()])
    rows = rows.select("doc_id", *[_spans(f"f_{k}").alias(k) for k in patterns])
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    rows = rows.withColumn("assign", F.filter("assign", lambda s: F.length(value(s)) >= ASSIGN_VALUE))
    base = F.flatten(F.array(*[F.transform(kind, _of_kind(k)) for k, kind in enumerate(KINDS[:3])]))
    rows = rows.select("doc_id", F.array_sort(base).alias("base"), "random")
    free = _outside("random", "base")
    # a number for each row that stays the same once the table is written
    rows = stored(
        rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", free.alias("random")),
        "secret-spans",
    )
    tested = battery(rows.select("row", F.explode("random").alias("s")).select("row", "s.start", "s.end", "s.value"))
    binned = lambda p: F.floor(-F.log10(F.greatest(F.lit(1e-100), p)) * BINS).cast("int")
    tested = stored(
        tested.withColumn("class", length_class(F.col("n")))
        .withColumn("bin", binned(F.col("p")))
        .withColumn("text_bin", binned(text_p(F.col("value"), described))),
        "secret-tests",
    )
    strata = ["encoding", "class"]
    bounds = limits(tested, rate).join(limits(tested, rate, "text_bin", "text_limit"), strata, "full")
    secrets = (
        tested.join(F.broadcast(bounds), strata)  # without a bound no text is rejected
        .where(F.col("limit").isNull() | (F.col("bin") < F.col("limit")))
        .where(F.col("text_bin") >= F.col("text_limit"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end", "value")).alias("more"))
    )
    joined = rows.join(secrets, "row", "left")
    whole = F.concat(F.col("base"), F.coalesce("more", F.array().cast(rows.schema["base"].dataType)))
    return joined.select("doc_id", F.array_sort(whole).alias("spans"))


def digest_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )
