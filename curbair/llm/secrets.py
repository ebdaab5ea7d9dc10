"""Secret scan: fixed patterns, and random strings told from text by a test battery.

Patterns give the base spans. Besides, every run of characters that secrets are written
in is a candidate, up to an ``=`` that is not padding at its end; so is every part of it
between characters that only one of base64 and base64url has (``+/`` and ``_-``), so that
what stands before or behind a secret does not hide it. A candidate's encoding is
inferred from the characters it has, and three tests
ask whether it could be drawn evenly from that encoding's alphabet: chi-squared
uniformity of the symbols, the number of runs above and below the middle of the
alphabet, and serial correlation of neighbouring symbols. Text fails them. The three
p-values are combined (Bonferroni), and among candidates of one encoding and length band
the Benjamini-Hochberg rule decides which ones are not random at a false-discovery rate
of ``rate``. What the rule does not reject, and is long enough for the tests to have
power, is reported as ``random``, but not what lies within another reported candidate.

Everything is a native expression: positions come from the lengths of what a pattern
matches and of what lies between. Ranks of p-values come from a histogram of fixed size,
so no group of candidates is ever sorted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Fixed patterns. Letters of ``assign`` match in either case.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
KINDS = ("assign", "access", "hex", "random")

#: What candidates are made of, and how short one may be.
CANDIDATE, CANDIDATE_CHARS = r"[A-Za-z0-9+/_=-]+", 20


def _parts(inside: str, bounds: tuple[tuple[str, str], ...] = ()) -> str:
    """Maximal runs of ``inside`` with their padding, in runs of CANDIDATE that are long
    enough. With ``bounds``, only runs that have a character of one of these pairs of
    classes before and behind them; an empty class asks for nothing.

    A match starts only where a run does, so each character is read a few times at most."""
    padding = "=++(?![A-Za-z0-9+/_=-])"
    run, least = f"[{inside}]++(?:{padding})?+", CANDIDATE_CHARS
    long = f"(?=[{inside}]{{{least}}}|(?=[={inside}]{{{least}}})[{inside}]++{padding})"
    asked = "|".join((f"(?<=[{a}])" if a else "") + run + (f"(?=[{b}])" if b else "") for a, b in bounds)
    return f"(?<![{inside}]){long}(?:{asked or run})"


#: Whole runs; parts between base64's own characters, between base64url's, and between
#: one of each. A part with no such neighbour is the same as one of a line before.
WHOLE = _parts("A-Za-z0-9+/_-")
PARTS = (
    _parts("A-Za-z0-9_-", (("+/", ""), ("", "+/"))),
    _parts("A-Za-z0-9+/", (("_-", ""), ("", "_-"))),
    _parts("A-Za-z0-9", (("+/", "_-"), ("_-", "+/"))),
)


@dataclass(frozen=True)
class Encoding:
    """An alphabet in the order of its symbols, and the pattern that infers it."""

    name: str
    alphabet: str
    pattern: str
    shortest: int


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Tried in this order; each wants digits and letters, so words never qualify.
ENCODINGS = (
    Encoding("hex", _DIGITS + "abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", 20),
    Encoding("HEX", _DIGITS + "ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", 20),
    Encoding("base32", _UPPER + "234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", 24),
    Encoding("BASE36", _DIGITS + _UPPER, r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", 24),
    Encoding("base36", _DIGITS + _LOWER, r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", 24),
    Encoding("base62", _DIGITS + _UPPER + _LOWER, r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$", 24),
    Encoding("base64", _UPPER + _LOWER + _DIGITS + "+/", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+=*$", 24),
    Encoding("base64url", _UPPER + _LOWER + _DIGITS + "-_", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+=*$", 24),
)
#: A band ends below each of these lengths; the last has no end.
BANDS = (32, 48, 64, 128, 512)
#: -log10(p) is counted in this many bins per unit, up to this value.
BINS, BIN_TOP = 20, 40
RATE = 0.01
_BLOCK = 256


def _running(lengths: Column) -> Column:
    """Sums of all elements before each one, in blocks: linear work for long arrays."""
    n = F.size(lengths)
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, v: s + v)
    sums = F.transform(blocks, lambda b: total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))
    # bound once, as element i of a one-element array, so that lambdas do not compute it again
    before = F.transform(F.array(sums), lambda s: F.transform(blocks, lambda b: total(F.slice(s, F.lit(1), b))))[0]
    spread = F.transform(F.array(before), lambda s: F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.element_at(s, F.floor(i / _BLOCK).cast("int") + 1)
        + total(F.slice(lengths, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK))))[0]
    return F.when(n > 0, spread).otherwise(F.array().cast("array<int>"))


def _matches(text: Column, pattern: str, value_group: int, least: int) -> Column:
    """Matches of a pattern from left to right: (start, end, value), those with a value
    of at least ``least`` characters; an empty array for most texts, found by one look."""
    spans = "array<struct<start:int,end:int,value:string>>"
    # bound as lambda variables: each regular expression runs once per text
    def located(parts: Column) -> Column:
        lengths = F.transform(parts["hit"], lambda h: F.length(h))
        gaps = F.transform(parts["gap"], lambda g: F.length(g))
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(lengths)), lengths, lambda g, h: g + h)
        return F.transform(F.array(F.struct(_running(steps).alias("b"), steps.alias("s"), lengths.alias("l"))), lambda z: F.zip_with(
            F.zip_with(z["b"], z["s"], lambda b, s: b + s), F.arrays_zip(z["l"].alias("l"), parts["value"].alias("v")),
            lambda end, h: F.struct((end - h["l"]).alias("start"), end.alias("end"), h["v"].alias("value"))))[0]

    # whole patterns get a group of their own, so that group 0 is never asked for twice
    hit = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = hit if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    parts = F.struct(F.split(text, pattern, -1).alias("gap"), hit.alias("hit"), value.alias("value"))
    found = F.transform(F.array(parts), located)[0]
    kept = F.filter(found, lambda m: F.length(m["value"]) >= least)
    return F.when(text.rlike(pattern), kept.cast(spans)).otherwise(F.array().cast(spans))


def _long_runs(pattern: str, least: int) -> str:
    """A run of one character class, at least ``least`` long.

    Runs are maximal, so this finds what dropping shorter ones leaves."""
    return pattern.removesuffix("+") + f"{{{least},}}"


def base_spans(text: Column) -> dict[str, Column]:
    """Arrays of (start, end, value) for each fixed kind, in code points."""
    # AKIA is made of the letters that may follow it, so a run too short holds no later match
    access = ACCESS.removesuffix("+") + f"{{{ACCESS_CHARS - 4},}}"
    return {
        "assign": _matches(text, ASSIGN, 2, ASSIGN_CHARS),
        "access": _matches(text, access, 0, ACCESS_CHARS),
        "hex": _matches(text, _long_runs(HEX, HEX_CHARS), 0, HEX_CHARS),
    }


def _upper_tail(z: Column) -> Column:
    """The normal distribution beyond ``z``, by the rational approximation 26.2.17 of
    Abramowitz and Stegun (error below 1e-7), with its asymptotic form far out."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    density = F.exp(-a * a / 2) * 0.3989422804014327
    tail = F.when(a < 5, density * series).otherwise(density / (a + 1 / a))
    return F.when(z < 0, 1 - tail).otherwise(tail)


def _p_value(symbols: Column, alphabet: Column) -> Column:
    """Bonferroni's combination of the three tests for one string of an alphabet."""
    k, n = F.length(alphabet).cast("double"), F.length(symbols).cast("double")
    codes = F.transform(F.split(symbols, ""), lambda c: F.instr(alphabet, c).cast("double") - 1 - (k - 1) / 2)
    counts = F.transform(F.split(alphabet, ""), lambda c: n - F.length(F.replace(symbols, c, F.lit(""))))
    squares = F.aggregate(counts, F.lit(0.0), lambda s, c: s + c * c)
    pairs = F.transform(F.array(codes), lambda x: F.zip_with(
        F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b"))))[0]
    # runs: a new one begins wherever neighbours lie on different sides of the middle
    sums = F.aggregate(
        pairs, F.struct(F.lit(0.0).alias("turns"), F.lit(0.0).alias("product")),
        lambda s, p: F.struct((s["turns"] + F.when((p["a"] > 0) != (p["b"] > 0), 1.0).otherwise(0.0)).alias("turns"),
                              (s["product"] + p["a"] * p["b"]).alias("product")))

    def tails(v: Column) -> Column:
        k, n = v["k"], v["n"]
        # chi-squared by Wilson and Hilferty
        chi, free = k * v["squares"] / n - n, k - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        # under the null neighbours lie on different sides half the time
        z_runs = (v["sums"]["turns"] - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        # the mean square of an evenly drawn symbol is (k^2 - 1) / 12
        z_serial = v["sums"]["product"] / ((k * k - 1) / 12) / F.sqrt(n - 1)
        return F.array(z_chi, F.abs(z_runs), F.abs(z_serial))

    bound = F.struct(k.alias("k"), n.alias("n"), squares.alias("squares"), sums.alias("sums"))
    z = F.transform(F.array(bound), tails)[0]
    # chi-squared is one-sided, the others are two-sided
    p = F.array_min(F.transform(z, lambda v, i: F.when(i == 0, 1.0).otherwise(2.0) * _upper_tail(v)))
    return F.greatest(F.least(3 * p, F.lit(1.0)), F.lit(1e-300))


def _band(length: Column) -> Column:
    return sum([F.when(length >= b, 1).otherwise(0) for b in BANDS], F.lit(0)).cast("int")


def candidates(text: Column) -> Column:
    """Candidates of a text: (start, end, stratum, bin, part). The stratum is encoding and
    length band; the bin grows with the evidence against randomness; parts are flagged."""
    level = lambda pattern, part: F.transform(
        _matches(text, pattern, 0, CANDIDATE_CHARS), lambda m: m.withField("part", F.lit(part)))
    found = F.concat(level(WHOLE, False), *[level(p, True) for p in PARTS])
    # most texts have no run that is long enough, which one look tells
    found = F.when(text.rlike(_long_runs(CANDIDATE, CANDIDATE_CHARS)), found).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string,part:boolean>>"))

    def encoded(m: Column) -> Column:
        code = F.lit(None).cast("int")
        for i, e in reversed(list(enumerate(ENCODINGS))):
            code = F.when(m["value"].rlike(e.pattern) & (F.length(m["value"]) >= e.shortest), F.lit(i)).otherwise(code)
        return m.withField("code", code)

    def judged(m: Column) -> Column:
        alphabet = F.element_at(F.array(*[F.lit(e.alphabet) for e in ENCODINGS]), m["code"] + 1)
        p = _p_value(F.rtrim(m["value"], F.lit("=")), alphabet)
        level = F.floor(F.least(-F.log10(p), F.lit(float(BIN_TOP))) * BINS).cast("int")
        return F.struct(m["start"].alias("start"), m["end"].alias("end"),
                        (m["code"] * (len(BANDS) + 1) + _band(F.length(m["value"]))).alias("stratum"), level.alias("bin"),
                        m["part"].alias("part"))

    return F.transform(F.filter(F.transform(found, encoded), lambda m: m["code"].isNotNull()), judged)


def rejection_bins(docs: DataFrame, text_col: str = "text", rate: float = RATE) -> dict[int, int]:
    """Per stratum the lowest bin whose candidates are rejected as not random.

    Benjamini and Hochberg over all candidates of the table: a bin's p-value at its
    weak end must not exceed ``rate`` times the share of candidates in it or above.
    At most strata x bins counts reach the driver."""
    text = F.col(text_col).cast("string")
    bins = docs.filter(text.rlike(_long_runs(CANDIDATE, CANDIDATE_CHARS))).select(
        F.explode_outer(candidates(text)).alias("c")).filter("c is not null").groupBy("c.stratum", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    counts: dict[int, dict[int, int]] = {}
    for r in bins.collect():
        counts.setdefault(r.stratum, {})[r.bin] = r.n
    limits = {}
    for stratum, per in counts.items():
        total, above = sum(per.values()), 0
        for level in sorted(per, reverse=True):
            above += per[level]
            if 10.0 ** (-level / BINS) <= rate * above / total:
                limits[stratum] = level
    return limits


def random_spans(text: Column, limits: dict[int, int]) -> Column:
    """Candidates that the battery leaves standing, as ``candidates`` gives them, without
    those that lie within another."""
    if not limits:
        return _outermost(candidates(text))
    table = F.create_map(*[F.lit(v) for pair in sorted(limits.items()) for v in pair])
    above = F.lit(BINS * BIN_TOP + 1)
    return _outermost(F.filter(candidates(text), lambda c: c["bin"] < F.coalesce(F.try_element_at(table, c["stratum"]), above)))


def _outermost(spans: Column) -> Column:
    """The candidates that no other one holds, by start."""
    def by_start(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda c: F.struct(c["start"].alias("start"), (-c["end"]).alias("back"), c.alias("c"))))
        # one held by another comes after it, and ends no later than the furthest so far
        state = F.aggregate(
            ordered, F.struct(F.slice(found, 1, 0).alias("kept"), F.lit(0).alias("reach")),
            lambda a, o: F.when(-o["back"] > a["reach"], F.struct(F.concat(a["kept"], F.array(o["c"])).alias("kept"), (-o["back"]).alias("reach"))).otherwise(a))
        return state["kept"]

    # whole runs never overlap
    return F.transform(F.array(spans), lambda s: F.when(F.exists(s, lambda c: c["part"]), by_start(s)).otherwise(s))[0]


def _joined(spans: Column) -> Column:
    order = F.array_sort(spans)
    return F.array_join(F.transform(order, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def _marked(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """Per document: its id, n_assign, n_access, n_hex, base_sha256 and spans.

    ``spans`` has kind:start:end by start, then kind in the order of KINDS, positions in
    code points with the end exclusive; ``base_sha256`` is the hash of the same list of
    the base kinds alone. A NULL text is empty. Repeated rows give repeated results, an
    empty table an empty one; other columns are not read.
    """
    limits = rejection_bins(docs, text_col, rate)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    found = rows.select("id", *[c.alias(k) for k, c in base_spans(F.col("text")).items()],
                        random_spans(F.col("text"), limits).alias("random"))
    marked = found.select(
        "id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.concat(*[_marked(F.col(k), i) for i, k in enumerate(KINDS[:3])]).alias("base"),
        _marked(F.col("random"), 3).alias("random"))
    return marked.select(
        F.col("id").alias(id_col), "n_assign", "n_access", "n_hex",
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("base", "random")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]", rate: float = RATE) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``, overlapping spans by
    one. Texts without spans, NULL ones included, stay as they are; so do all columns."""
    limits = rejection_bins(docs, text_col, rate)
    text = F.col(text_col).cast("string")
    spans = F.concat(*[_marked(c, i) for i, c in enumerate([*base_spans(text).values(), random_spans(text, limits)])])
    found = docs.withColumn(text_col, F.struct(text.alias("text"), F.array_sort(spans).alias("spans")))
    whole, found_spans = F.col(text_col)["text"], F.col(text_col)["spans"]

    def cut(s: Column) -> Column:
        # what lies between spans is taken over, from the end of the last one
        state = F.aggregate(
            s, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
            lambda a, p: F.when(
                p["start"] >= a["at"],
                F.struct(F.concat(a["out"], F.substring(whole, a["at"] + 1, p["start"] - a["at"]), F.lit(mark)).alias("out"),
                         p["end"].alias("at"))
            ).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], p["end"]).alias("at"))))
        return F.transform(F.array(state), lambda z: F.concat(z["out"], F.substring(whole, z["at"] + 1, F.length(whole))))[0]

    return found.withColumn(text_col, F.when(F.size(found_spans) > 0, cut(found_spans)).otherwise(whole))
