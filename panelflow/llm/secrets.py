"""Secret scans with SQL functions only: fixed patterns, and a battery of randomness tests.

The null hypothesis of the battery is that a token is text-like. Its chi-squared statistic of
uniformity over the alphabet then follows a noncentral law whose shift grows with the length, and
its changes of character class are few; a random token is far below the first and above the
second. Both scores are combined, and the Benjamini-Hochberg rule is applied within
each encoding and octave of length, so a short token must be more extreme than a long one. A token
that is not uniform, or whose neighbours correlate, is not taken for random.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelflow.session import materialised

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs that are too short fail as a whole, so the least length may stand in these two patterns.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ["assign", "access", "hex", "random"]

UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Name, pattern and alphabet; the first that fits is the token's encoding.
ENCODINGS = [
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^([a-z0-9]+|[A-Z0-9]+)$", LOWER + DIGITS),
    ("base64", ".", UPPER + LOWER + DIGITS + "+/"),
]
CHUNK = 512


def prefix_sums(sizes: Column) -> Column:
    """Sums of all earlier elements, for an array of any length.

    Appending to an array copies it, so sums are made within chunks, then over chunks.
    """
    one = F.array(F.lit(0))

    def sums(a: Column) -> Column:
        return F.aggregate(a, one, lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))

    def whole(a: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int")), lambda c: sums(F.slice(a, c * CHUNK + 1, F.lit(CHUNK)))
        )
        return let(
            chunks,
            lambda p: F.flatten(
                F.zip_with(
                    p,
                    let(sums(F.transform(p, lambda x: F.element_at(x, -1))), lambda b: F.slice(b, F.lit(1), F.size(p))),
                    lambda x, b: F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda v: v + b),
                )
            ),
        )

    return let(sizes, lambda a: F.when(F.size(a) > 0, whole(a)).otherwise(F.array().cast("array<int>")))


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, pattern: str, kind: str, value: Column | None = None, least: int = 0) -> Column:
    """Places of a pattern's leftmost matches, in code points: array of (start, kind, end).

    The matches and the pieces between them alternate; their summed lengths are the places.
    Only texts with a match are split. With `value` (a group of each match), shorter ones go.
    """
    kind_no = KINDS.index(kind)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def located(m: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        sizes = F.flatten(F.zip_with(pieces, m, lambda p, x: F.array(F.length(p), F.coalesce(F.length(x), F.lit(0)))))
        return let(
            prefix_sums(sizes),
            lambda at: F.transform(
                m,
                lambda x, k: F.struct(
                    F.get(at, 2 * k + 1).alias("start"),
                    F.lit(kind_no).alias("kind"),
                    (F.get(at, 2 * k + 1) + F.length(x)).alias("end"),
                ),
            ),
        )

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, located(m)).otherwise(empty))
    if value is None:
        return found
    long = let(value, lambda v: F.filter(found, lambda s, k: F.length(F.get(v, k)) >= least))
    return F.when(text.rlike(pattern), long).otherwise(empty)


def _upper_tail(z: Column) -> Column:
    """The normal upper tail, by Bryc's rational form (relative error below 2e-5 for z >= 0)."""
    x = F.abs(z)
    top = x * x + 5.575192695 * x + 12.77436324
    low = 2.5066282746 * x * x * x + 14.38718147 * x * x + 31.53531977 * x + 25.54872648
    q = top / low * F.exp(-x * x / 2)
    return F.when(z >= 0, q).otherwise(1 - q)


def battery(tokens: DataFrame, class_rate: float = 0.2, veto: float = 3.3) -> DataFrame:
    """Adds encoding, octave, log_p and passes to rows with a `token`.

    `log_p` is the decimal logarithm of the probability, for a text-like token, of looking as random
    as this one. `passes` is false if uniformity or serial independence is rejected at
    `veto` standard deviations.
    """
    named = F.coalesce(*(F.when(F.col("body").rlike(p), F.lit(n)) for n, p, _ in ENCODINGS))
    alphabet = F.coalesce(*(F.when(F.col("encoding") == n, F.lit(a)) for n, _, a in ENCODINGS))
    body = F.regexp_replace(F.regexp_replace("token", "=+$", ""), "_", "/")
    t = tokens.withColumn("body", F.translate(body, "-", "+")).withColumn("encoding", named)
    folds = F.when(F.col("encoding").isin("hex", "base36"), F.lower("body")).otherwise(F.col("body"))
    t = t.withColumn("folded", folds).withColumn("alphabet", alphabet).withColumn("n", F.length("body").cast("double"))
    t = t.withColumn("k", F.length("alphabet").cast("double"))
    seen = F.transform(
        F.split("alphabet", "(?!^)"), lambda c: F.pow((F.col("n") - F.length(F.replace(F.col("folded"), c, F.lit("")))).cast("double"), F.lit(2))
    )
    t = t.withColumn("squares", F.aggregate(seen, F.lit(0.0), lambda a, x: a + x))
    t = t.withColumn("chi2", F.col("k") / F.col("n") * F.col("squares") - F.col("n"))
    shift = F.col("n") * (F.col("k") * F.greatest(F.lit(0.065), 2 / F.col("k")) - 1)
    free = F.col("k") - 1
    text_z = (F.col("chi2") - free - shift) / F.sqrt(2 * free + 4 * shift)
    # Wilson and Hilferty's cube root makes chi-squared nearly normal
    flat_z = (F.pow(F.col("chi2") / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    changes = F.when(
        F.col("encoding") == "decimal", F.regexp_count("body", F.lit("(?<=[0-4])[5-9]|(?<=[5-9])[0-4]"))
    ).otherwise(F.regexp_count("body", F.lit("(?<=[a-z])[A-Z]|(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]")))
    pairs = F.col("n") - 1
    rate = F.when(F.col("encoding") == "decimal", F.lit(0.3)).otherwise(F.lit(class_rate))
    runs_z = (changes - pairs * rate) / F.sqrt(pairs * rate * (1 - rate))
    codes = F.transform(F.split("folded", "(?!^)"), lambda c: F.instr(F.col("alphabet"), c).cast("double"))
    t = t.withColumn("codes", codes)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    mean = total(F.col("codes")) / F.col("n")
    t = t.withColumn("off", let(mean, lambda m: F.transform("codes", lambda x: x - m)))
    lagged = F.zip_with(F.slice("off", F.lit(1), F.size("off") - 1), F.slice("off", F.lit(2), F.size("off") - 1), lambda a, b: a * b)
    power = total(F.transform("off", lambda x: x * x))
    serial = F.coalesce(F.try_divide(total(lagged), power), F.lit(1.0))
    p = _upper_tail((runs_z - text_z) / F.sqrt(F.lit(2.0)))
    return t.select(
        *tokens.columns,
        "encoding",
        F.floor(F.log2("n")).cast("int").alias("octave"),
        F.log10(F.greatest(p, F.lit(1e-300))).alias("log_p"),
        ((flat_z < veto) & (F.abs(serial) * F.sqrt("n") < veto)).alias("passes"),
    )


def discoveries(tested: DataFrame, rate: float = 0.01, width: float = 0.05) -> DataFrame:
    """Rows that pass and are found at the false-discovery `rate` in their encoding and octave.

    The step-up rule is read from a histogram of log_p (bins of `width`, at most 300 / width
    a stratum) with each bin's upper end, so the error stays below the rate.
    """
    keys = ["encoding", "octave"]
    binned = tested.withColumn("bin", F.floor(F.col("log_p") / width).cast("int"))
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*keys)
    run = counts.withColumn("upto", F.sum("c").over(w.orderBy("bin"))).withColumn("all", F.sum("c").over(w))
    ok = (F.col("bin") + 1) * width <= F.log10(rate * F.col("upto") / F.col("all"))
    last = run.filter(ok).groupBy(*keys).agg(F.max("bin").alias("last"))
    return binned.join(last, keys).filter(F.col("passes") & (F.col("bin") <= F.col("last"))).drop("bin", "last")


def _listed(found: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    each = F.transform(F.array_sort(found), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(each, ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01) -> DataFrame:
    """Spans of every row of `docs`: (id, base, found); both are arrays of (start, kind, end).

    `base` has the spans of the fixed patterns: per kind the leftmost that do not overlap, without
    assignments of fewer than 6 characters. `found` has the random tokens outside of them.
    A null text counts as empty. Ties sort by start, then kind, then end; repeated rows each
    give a row; an empty table gives an empty result. Other columns are not touched.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    base = F.concat(
        spans(text, ASSIGN, "assign", F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), 6),
        spans(text, ACCESS, "access"),
        spans(text, HEX, "hex"),
    )
    token = spans(text, TOKEN, "random")
    read = rows.select("id", F.xxhash64("text").alias("text_hash"), text.alias("text"), base.alias("base"), token.alias("token"))
    read = read.select(
        "id",
        "text_hash",
        "base",
        F.transform("token", lambda s: F.struct(s["start"], s["end"], F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]).alias("token"))).alias("tokens"),
    )
    read = materialised(read, "spans")
    outside = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    tokens = read.select("id", "text_hash", F.explode(outside).alias("t")).select("id", "text_hash", "t.start", "t.end", "t.token")
    random = discoveries(battery(tokens), rate).select("id", "text_hash", F.struct("start", F.lit(3).alias("kind"), "end").alias("s"))
    random = random.groupBy("id", "text_hash").agg(F.collect_set("s").alias("found"))
    other = random.select(F.col("id").alias("id2"), F.col("text_hash").alias("hash2"), "found")
    same = read["id"].eqNullSafe(other["id2"]) & (read["text_hash"] == other["hash2"])
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return read.join(other, same, "left").select("id", "base", F.coalesce("found", none).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and the written form of the spans of `scan`."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "found")).alias("spans"),
    )
