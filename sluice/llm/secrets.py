"""Secret scans in DataFrame functions: three fixed patterns, and entropy in a sliding window.

Candidates for the entropy test are long runs of the base64 alphabet.  A window
of ``WINDOW`` characters slides over each; the counts of its characters change
by one coming and one going, and so does the sum that its Shannon entropy is
made of.  A candidate of hexadecimal characters has the hexadecimal class's
limit, any other the base64 class's.  Allow-listed candidates are no secrets.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Patterns whose matches are always reported (fixed values); letters of the first names in either case.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
HEX_ALPHABET = "0123456789abcdef"
#: Bits per character from which a window counts as random.
BASE64_BITS, HEX_BITS = 3.9, 3.0
#: Candidates that are known not to be secrets.
ALLOW = (
    r"^[A-Za-z+/_=-]+$", r"^[0-9+/_=-]+$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"(?i)example|sample|placeholder|changeme|dummy",
    r"(?i)abcdefgh|01234567", r"^sha(1|256|384|512)-",
)
REDACTED = "[REDACTED]"
#: Elements that one running total is taken over; longer arrays are done in groups.
GROUP = 512
_SPAN = "struct<start:bigint,end:bigint,kind:int>"


def _let(value, body):
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values, combine, zero):
    """Running ``combine`` of an array of longs, in groups so that a long one is not copied per element."""
    start = F.lit(zero).cast("long")
    last = lambda acc: F.element_at(acc, -1)
    push = lambda acc, x: F.concat(acc, F.array(combine(last(acc), x)))

    def whole(groups):
        totals = F.aggregate(groups, F.array(start), lambda acc, g: push(acc, F.aggregate(g, start, combine)))
        return _let(totals, lambda base: F.flatten(F.transform(groups, lambda g, t: F.slice(
            F.aggregate(g, F.array(F.get(base, t)), push), 2, F.size(g)))))

    def grouped(v):
        cut = F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(v) - 1) / GROUP).cast("int")), lambda t: F.slice(v, t * GROUP + 1, F.lit(GROUP)))
        return F.when(F.size(v) > 0, _let(cut, whole)).otherwise(F.array().cast("array<bigint>"))

    return _let(values, grouped)


def _lengths(texts):
    return F.transform(texts, lambda x: F.length(x).cast("long"))


def _matches(text, pattern):
    """Spans (start, end) of all matches, leftmost and not overlapping."""
    found = _lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = _lengths(F.split(text, pattern, -1))

    def spans(m):
        ends = _running(F.zip_with(gaps, m, lambda g, x: g + F.coalesce(x, F.lit(0))), lambda a, b: a + b, 0)
        # The piece after the last match has no match; it ends the pairing.
        return F.zip_with(F.slice(ends, 1, F.size(m)), m, lambda e, n: F.struct((e - n).alias("start"), e.alias("end")))

    return _let(found, spans)


def _as_kind(spans, kind):
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _where(text, pattern, spans):
    """Work on matches only where there is one."""
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _assigned(text):
    values = _lengths(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))
    pairs = F.filter(F.arrays_zip(_matches(text, ASSIGN).alias("s"), values.alias("v")), lambda x: x["v"] >= ASSIGN_CHARS)
    return _where(text, ASSIGN, _as_kind(F.transform(pairs, lambda x: x["s"]), 0))


def _plain(text, pattern, least, kind):
    # The longest run from its first place: shorter runs never hide a longer one.
    pattern = f"{pattern[:-1]}{{{least},}}"
    return _where(text, pattern, _as_kind(_matches(text, pattern), kind))


def _hot_range(codes, symbols, limit):
    """First start and last end of the windows whose entropy reaches ``limit``: struct(first, last), last 0 if none.

    ``codes``: numbers below ``symbols`` of the characters.
    """
    grow = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    state = F.struct(F.array_repeat(F.lit(0), symbols).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("first"), F.lit(0).alias("last"))

    def step(s, i):
        coming = F.get(codes, i - 1)
        going = F.when(i > WINDOW, F.get(codes, i - WINDOW - 1)).otherwise(-1)

        def moved(pair):
            c, g = pair["c"], pair["g"]
            less = F.when(g >= 0, F.get(grow, F.get(s["counts"], g) - 1) - F.get(grow, F.get(s["counts"], g))).otherwise(0.0)
            have = F.get(s["counts"], c)
            total = F.when(c == g, s["sum"]).otherwise(s["sum"] + less + F.get(grow, have + 1) - F.get(grow, have))
            counts = F.when(c == g, s["counts"]).otherwise(
                F.transform(s["counts"], lambda n, j: n + F.when(j == c, 1).otherwise(0) - F.when(j == g, 1).otherwise(0)))

            def judged(t):
                hot = (i >= WINDOW) & (math.log2(WINDOW) - t / WINDOW >= limit)
                return F.struct(
                    counts.alias("counts"), t.alias("sum"),
                    F.when(hot & (s["last"] == 0), i - WINDOW).otherwise(s["first"]).alias("first"),
                    F.when(hot, i).otherwise(s["last"]).alias("last"))

            return _let(total, judged)

        return _let(F.struct(coming.alias("c"), going.alias("g")), moved)

    return F.aggregate(F.sequence(F.lit(1), F.size(codes)), state, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _codes(text, alphabet):
    return F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)


def _random(text, allow):
    allowed = lambda c: F.regexp_like(c, F.lit("|".join(f"(?:{a})" for a in allow))) if allow else F.lit(False)
    strings = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    pairs = F.filter(F.arrays_zip(_matches(text, CANDIDATE).alias("s"), strings.alias("c")), lambda x: ~allowed(x["c"]))

    def judged(x):
        is_hex = F.regexp_like(x["c"], F.lit("^[0-9A-Fa-f]+$"))
        hexadecimal = _let(_codes(F.lower(x["c"]), HEX_ALPHABET), lambda codes: _hot_range(codes, len(HEX_ALPHABET), HEX_BITS))
        base64 = _let(_codes(x["c"], ALPHABET), lambda codes: _hot_range(codes, len(ALPHABET), BASE64_BITS))
        hot = F.when(is_hex, hexadecimal).otherwise(base64)
        return _let(hot, lambda h: F.struct((x["s"]["start"] + h["first"]).alias("start"), (x["s"]["start"] + h["last"]).alias("end"), F.lit(3).alias("kind")))

    spans = F.filter(F.transform(pairs, judged), lambda s: s["end"] > s["start"])
    return _where(text, CANDIDATE, F.filter(spans, lambda s: s["end"] - s["start"] >= WINDOW))


def scan(docs: DataFrame, text_col="text", allow=ALLOW) -> DataFrame:
    """``docs`` with ``secret_spans``: array of (start, end, kind) by start, then kind.

    Code points, end exclusive; kind is a place in ``KINDS``.  A null or empty
    text has none.  A column of that name is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = docs.drop("secret_spans").withColumns({
        "_assign": _assigned(text), "_access": _plain(text, ACCESS, ACCESS_CHARS - len("AKIA"), 1),
        "_hex": _plain(text, HEX, HEX_CHARS, 2), "_entropy": _random(text, allow)})
    by_place = F.array_sort(F.transform(F.concat("_assign", "_access", "_hex", "_entropy"), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    spans = F.transform(by_place, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return kinds.withColumn("secret_spans", spans).drop("_assign", "_access", "_hex", "_entropy")


def redact(docs: DataFrame, text_col="text", allow=ALLOW, sizes_col=None) -> DataFrame:
    """``docs`` with every span, overlapping ones together, replaced by ``REDACTED``; a null text stays null.

    ``sizes_col``, if given, is set to the length of a changed text.
    """
    found = scan(docs, text_col, allow)
    text = F.col(text_col)

    def pieces(spans):
        reach = _running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), 0)

        def cut(far):
            before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(far, i - 1))
            head = F.transform(spans, lambda s, i: F.when(
                (i == 0) | (s["start"] > before(i)),
                F.concat(F.substr(text, (before(i) + 1).cast("int"), (s["start"] - before(i)).cast("int")), F.lit(REDACTED))).otherwise(""))
            return F.concat(F.array_join(head, ""), F.substr(text, (F.element_at(far, -1) + 1).cast("int")))

        return _let(reach, cut)

    changed = F.size("secret_spans") > 0
    out = found.withColumn(text_col, F.when(changed, pieces(F.col("secret_spans"))).otherwise(text))
    if sizes_col:
        out = out.withColumn(sizes_col, F.when(changed, F.length(text_col)).otherwise(F.col(sizes_col)).cast(docs.schema[sizes_col].dataType))
    return out.drop("secret_spans")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    found = scan(docs.select("doc_id", "text")).select("doc_id", "secret_spans")
    names = F.array(*map(F.lit, KINDS))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    spans = F.col("secret_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(told(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"), told(spans).alias("spans"))
