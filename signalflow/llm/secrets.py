"""Secret scan: three fixed patterns, and a battery of randomness tests for strings the patterns miss.

A key or token is drawn at random from the alphabet of an encoding; a name, path, date or number is
not. Every long enough string whose characters fit an encoding (hexadecimal, base32, base36, base62, base64)
is tested for uniform use of the alphabet (chi-squared), for the number of runs above and below the
alphabet's middle, and for correlation of neighbours. A string that looks unlike random in any test
is a discovery of structure; the discoveries are limited to a given false rate by the step-up rule of
Benjamini and Hochberg, within each encoding and length class, because tests of short strings see
little. Strings without a discovery are reported.

Everything is DataFrame functions: positions come from the lengths of the pieces between matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalflow.session import written

# Fixed patterns. Letters of the assigned names in either case, spelt out; of the others the `+` form
# with a least length is the same as a quantifier from that length on, since its runs are maximal.
ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
LEAST_ASSIGNED = 12
# Candidates of the method: maximal runs of these characters; an equals sign only ends one, so that a name before it is
# a run of its own.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Encodings by what their strings hold; the first that fits is taken. A string of one class of characters
# (a word, a number) fits none.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("BASE36", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("base62", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
# Least characters of a string, so that the chi-squared test has a meaning.
LEAST_RANDOM = 20
# Rate of false discoveries of structure, and the steps per factor of ten in which p-values are counted.
FALSE_RATE = 0.05
STEPS = 20
LAST_STEP = 400


def _normal_tail(z: Column) -> Column:
    """Probability above ``z`` >= 0 (five-term polynomial of Abramowitz and Stegun, 26.2.17)."""
    t = 1 / (1 + F.lit(0.2316419) * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) * F.lit(0.3989422804014327) * poly


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _normal_tail(F.abs(z)))


def random_p(body: Column, alphabet: Column) -> Column:
    """Smallest of the three p-values, times three, under the hypothesis of a random string."""

    def battery(s: Column) -> Column:
        n, k, x = s["n"].cast("double"), s["k"].cast("double"), s["x"]
        counts = F.transform(F.array_distinct(x), lambda v: F.size(F.filter(x, lambda w: w == v)).cast("double"))
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c)
        chi, dof = squares * k / n - n, k - 1
        # Wilson and Hilferty: the cube root of a chi-squared value is nearly normal; too even counts matter as well
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / dof, F.lit(1 / 3)) - (1 - 2 / (9 * dof))) / F.sqrt(2 / (9 * dof))
        next_of = F.slice(x, 2, s["n"] - 1)
        high = F.transform(x, lambda v: v * 2 >= s["k"])
        n1 = F.size(F.filter(high, lambda v: v)).cast("double")
        n2 = n - n1
        turns = F.size(F.filter(F.zip_with(F.slice(high, 1, s["n"] - 1), F.slice(high, 2, s["n"] - 1), lambda a, b: a != b), lambda v: v))
        mean = 2 * n1 * n2 / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        z_runs = F.when((n1 == 0) | (n2 == 0), F.lit(9.0)).otherwise((turns + 1 - mean) / F.sqrt(F.greatest(variance, F.lit(0.01))))
        average = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n
        spread = F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - average) * (v - average))
        product = F.aggregate(
            F.zip_with(F.slice(x, 1, s["n"] - 1), next_of, lambda a, b: (a - average) * (b - average)), F.lit(0.0), lambda a, v: a + v
        )
        z_serial = F.when(spread == 0, F.lit(9.0)).otherwise((product / spread + 1 / n) * F.sqrt(n))
        return F.least(F.lit(1.0), 3 * F.least(_two_sided(z_chi), _two_sided(z_runs), _two_sided(z_serial)))

    places = F.transform(F.split(body, ""), lambda c: F.instr(alphabet, c) - 1)
    shape = F.struct(places.alias("x"), F.char_length(body).alias("n"), F.char_length(alphabet).alias("k"))
    return F.transform(F.array(shape), battery)[0]


def _spans(text: Column, pattern: str, groups: bool = False) -> Column:
    """Array of ``(start, end, value)`` of the matches, in code points, in order.

    The pieces between matches and the matches alternate; sums of their lengths are the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if groups else found
    between = F.split(text, pattern, -1)
    steps = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("hit"), value.alias("value"))
    empty = F.lit(None).cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), F.coalesce(empty, F.array().cast("array<struct<start:int,end:int,value:string>>")).alias("out"))

    def move(acc: Column, step: Column) -> Column:
        begin = acc["at"] + F.char_length(step["gap"])
        end = begin + F.char_length(step["hit"])
        return F.struct(
            end.alias("at"), F.array_append(acc["out"], F.struct(begin.alias("start"), end.alias("end"), step["value"].alias("value"))).alias("out")
        )

    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(steps, start, move, lambda a: a["out"])).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>")
    )


def _without_base(run: Column) -> Column:
    """The parts of a run that lie outside all spans of the column ``base``, which is in order."""

    def part(begin: Column, end: Column) -> Column:
        return F.struct(begin.alias("start"), end.alias("end"), F.substring(run["value"], begin - run["start"] + 1, end - begin).alias("value"))

    hits = F.filter("base", lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    begun = F.struct(run["start"].alias("at"), none.alias("out"))

    def cut(acc: Column, b: Column) -> Column:
        behind = F.greatest(acc["at"], b["end"])
        before = F.when(b["start"] > acc["at"], F.array_append(acc["out"], part(acc["at"], b["start"]))).otherwise(acc["out"])
        return F.struct(behind.alias("at"), before.alias("out"))

    def rest(acc: Column) -> Column:
        return F.when(acc["at"] < run["end"], F.array_append(acc["out"], part(acc["at"], run["end"]))).otherwise(acc["out"])

    return F.when(F.size(hits) == 0, F.array(run)).otherwise(F.aggregate(hits, begun, cut, rest))


def _of_kind(number: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"))


def _length_class(n: Column) -> Column:
    """Lengths of one class differ by less than a factor of two."""
    return F.floor(F.log2(n)).cast("int")


def _step(p: Column) -> Column:
    """Number of the p-value's step; a step stands for its upper, weaker end."""
    return F.least(F.lit(LAST_STEP), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEPS)).cast("int")


def structure_limits(tested: DataFrame) -> DataFrame:
    """Per encoding and length class the least step at which a string counts as structured.

    Benjamini and Hochberg: the weakest p-value that is at most ``FALSE_RATE`` times the share of strings
    with a p-value no greater. Counted by steps, so the tables have a bounded number of rows
    (encodings x classes x steps) whatever the corpus holds.
    """
    counts = tested.groupBy("encoding", "class", "step").agg(F.count("*").alias("n"))
    stratum = Window.partitionBy("encoding", "class")
    ranked = counts.withColumn("below", F.sum("n").over(stratum.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("all", F.sum("n").over(stratum))
    upper = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    return ranked.filter(upper * F.col("all") <= FALSE_RATE * F.col("below")).groupBy("encoding", "class").agg(F.min("step").alias("limit"))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``spans``, an array of ``(start, kind, end)`` in order, of every row of ``docs``.

    Kinds are numbered as in :data:`KINDS`, 3 is a string found by the tests alone. Spans of the patterns are taken out of
    a run of characters, and what is left on either side is tested if it is long enough. A NULL text is empty. The texts are scanned once; positions and p-values
    are written, then the limits are counted from them and applied. Rows are never shuffled.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = []
    for number, (kind, pattern) in enumerate(KINDS.items()):
        spans = _spans(F.col("whole"), pattern, groups=kind == "assign")
        if kind == "assign":
            spans = F.filter(spans, lambda s: F.char_length(s["value"]) >= LEAST_ASSIGNED)
        base.append(F.transform(spans, _of_kind(number)))
    rows = docs.select(F.col(id_col).alias("id"), whole.alias("whole"))
    rows = rows.select("id", F.array_sort(F.concat(*base)).alias("base"), _spans(F.col("whole"), CANDIDATE).alias("runs"))
    free = F.flatten(F.transform("runs", _without_base))
    encoding, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")

    def tested(r: Column) -> Column:
        name, letters = encoding, alphabet
        for known, shape, signs in reversed(ENCODINGS):
            fits = F.regexp_like(r["value"], F.lit(shape))
            name, letters = F.when(fits, F.lit(known)).otherwise(name), F.when(fits, F.lit(signs)).otherwise(letters)
        return F.struct(r["start"].alias("start"), r["end"].alias("end"), name.alias("encoding"), letters.alias("alphabet"), F.rtrim(r["value"], F.lit("=")).alias("body"))

    rows = rows.select("id", "base", F.filter(F.transform(free, tested), lambda r: r["encoding"].isNotNull() & (F.char_length(r["body"]) >= LEAST_RANDOM)).alias("runs"))

    def scored(r: Column) -> Column:
        return F.struct(r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"), _length_class(F.char_length(r["body"])).alias("class"), _step(random_p(r["body"], r["alphabet"])).alias("step"))

    rows = written(rows.select("id", "base", F.transform("runs", scored).alias("runs")), "secrets")
    limits = structure_limits(rows.select(F.inline("runs"))).collect()  # one row per encoding and length class
    if limits:
        known = F.create_map(*[F.lit(x) for r in limits for x in (f"{r['encoding']}:{r['class']}", r["limit"])])
    else:
        known = F.lit(None).cast("map<string,int>")
    limit = lambda r: F.coalesce(F.element_at(known, F.concat_ws(":", r["encoding"], r["class"].cast("string"))), F.lit(LAST_STEP + 1))
    random = F.filter("runs", lambda r: r["step"] < limit(r))
    added = F.transform(random, _of_kind(len(KINDS)))
    return rows.select("id", F.array_sort(F.concat("base", added)).alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in [*KINDS, "random"]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of every document."""
    found = scan(docs)
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)],
        count(len(KINDS)).alias("n_random"),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )
