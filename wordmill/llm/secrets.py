"""Secret scans: fixed patterns plus a sliding-window entropy search.

All steps are built-in expressions on one row, so nothing is shuffled. Match
positions come from two passes of the same pattern: the pieces between matches
(split) and the matches (extract_all) alternate, and their running lengths are
the code-point offsets.

The entropy search takes every candidate string (20 or more characters of
``[A-Za-z0-9+/_-]``) and slides a window of 20 characters over it. The window
holds a count per character; a step adds one character and removes another,
which changes the sum of c log2 c by two table look-ups. Tables hold
round(1e6 c log2 c), so the sums are exact integers. The entropy of a window is
log2(20) - sum / 20. A candidate is of one character class (hex, digits and
letters, letters of both cases, of one case, other), each with its own threshold,
and is reported if its best window reaches it, unless an allow-list pattern
matches it or a base span already holds it. An allow-list word (``example`` and
the like) clears the part between slashes that holds it; the other parts are
judged on their own.

Spans of a text, however many, take a running sum over blocks of BLOCK spans, so
a text with n of them costs about n BLOCK steps.

Defined cases: a null or empty text has no spans and the hash of an empty
string; a long text or candidate is scanned whole; repeated rows each get their
result; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, register

# Fixed patterns of the base kinds, in the order that breaks ties of start.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
# round(1e6 * c * log2(c)) for c = 0..WINDOW.
CLOGC = [0] + [round(1e6 * c * math.log2(c)) for c in range(1, WINDOW + 1)]


@dataclass(frozen=True)
class CharClass:
    """Candidates that match ``pattern`` whole (first class wins) are judged
    by ``min_bits`` of entropy per character in some window."""

    name: str
    pattern: str
    min_bits: float

    @property
    def max_sum(self) -> int:
        return math.floor(1e6 * WINDOW * (math.log2(WINDOW) - self.min_bits))


# Random hex has about 3.3 bits in 20 characters, random base64 about 4.1;
# words and identifiers stay under 3.7. Random letters of both cases have 4.0, of
# one case 3.7; words of 20 letters reach 3.58. Names with separators need nearly all
# characters distinct.
CLASSES = (
    CharClass("hex", r"^([0-9a-f]+|[0-9A-F]+)$", 3.0),
    CharClass("mixed", r"^(?=.*[0-9])(?=.*[A-Za-z]).*$", 3.7),
    CharClass("cased", r"^[A-Z]*[a-z]+[A-Z][A-Za-z]*$", 3.75),  # a capital after a small letter, without backtracking
    CharClass("letters", r"^[A-Za-z]+$", 3.65),
    CharClass("other", r"^.*$", 4.2),
)
BLOCK = 256  # spans of a text whose positions are summed together
# Words of values that look random but are no secrets.
WORDS = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]"
# Such values whole: UUIDs, paths, one character repeated.
ALLOW = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^/?([A-Za-z_-]+/)+[A-Za-z_-]*$",
    r"^(.)\1+$",
)



def _with(value: Column, body) -> Column:
    """body(value) with value computed once, also inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(items: Column, value, add, zero: Column) -> Column:
    """For each item, the values of the items before it, added up: first within
    blocks, then over the blocks' totals."""

    def before(xs: Column, start: Column, of) -> Column:
        none = F.filter(F.array(start), lambda x: x.isNull())
        first = F.struct(start.alias("at"), none.alias("out"))
        step = lambda a, x: F.struct(add(a["at"], of(x)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
        return F.aggregate(xs, first, step, lambda a: a["out"])

    def of_items(xs: Column) -> Column:
        last = F.greatest(F.floor((F.size(xs) - 1) / BLOCK), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(xs, b * BLOCK + 1, BLOCK))

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda xs: F.aggregate(xs, zero, lambda a, x: add(a, value(x))))
        return F.flatten(F.zip_with(blocks, before(totals, zero, lambda t: t), lambda xs, start: before(xs, start, value)))

    return _with(_with(items, of_items), of_blocks)


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<s,e,m>> of the leftmost non-overlapping matches, as code
    points with the end exclusive; empty if there are none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = _with(
        found,
        lambda f: F.slice(F.zip_with(between, f, lambda b, m: F.struct(F.length(b).alias("gap"), m.alias("m"))), 1, F.size(f)),
    )
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")

    def span(p: Column, at: Column) -> Column:
        s = at + p["gap"]
        return F.struct(s.alias("s"), (s + F.length(p["m"])).alias("e"), p["m"].alias("m"))

    def placed(ps: Column) -> Column:
        at = _running(ps, lambda p: p["gap"] + F.length(p["m"]), lambda a, x: a + x, F.lit(0))
        return F.zip_with(ps, at, span)

    return F.when(text.rlike(pattern), _with(pairs, placed)).otherwise(none)


def _put(counts: Column, at: Column, value: Column) -> Column:
    """counts with one place changed."""
    return F.concat(F.slice(counts, 1, at), F.array(value), F.slice(counts, at + 2, 128))


def least_sum(value: Column) -> Column:
    """Least sum of round(1e6 c log2 c) over the windows of an ASCII string of
    WINDOW or more characters, by counts that change by one character in and
    one out per step."""
    table = F.array(*[F.lit(x) for x in CLOGC])
    f = lambda c: F.get(table, c)
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c))
    steps = F.zip_with(
        codes,
        F.concat(F.array_repeat(F.lit(-1), WINDOW), F.slice(codes, 1, F.size(codes) - WINDOW)),
        lambda c, o: F.struct(c.alias("c"), o.alias("o")),
    )
    zero = F.struct(
        F.array_repeat(F.lit(0), 128).alias("n"),
        F.lit(0).alias("sum"),
        F.lit(0).alias("i"),
        F.lit(2**31 - 1).alias("least"),
    )

    def step(a: Column, x: Column) -> Column:
        c, o = x["c"], x["o"]
        into, out = F.get(a["n"], c), F.get(a["n"], o)
        swapped = F.when(o < 0, _put(a["n"], c, into + 1)).otherwise(
            _put(_put(a["n"], c, into + 1), o, F.when(c == o, into).otherwise(out - 1))
        )
        change = F.when(o < 0, f(into + 1) - f(into)).otherwise(f(into + 1) - f(into) + f(out - 1) - f(out))
        total = a["sum"] + F.when(c == o, F.lit(0)).otherwise(change)
        return F.struct(
            F.when(c == o, a["n"]).otherwise(swapped).alias("n"),
            total.alias("sum"),
            (a["i"] + 1).alias("i"),
            F.when(a["i"] >= WINDOW - 1, F.least(a["least"], total)).otherwise(a["least"]).alias("least"),
        )

    return F.aggregate(steps, zero, step, lambda a: a["least"])


def scan(docs: DataFrame, allow: tuple[str, ...] = ALLOW, words: str = WORDS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, spans: array<struct<s,k,e,m>> ordered by
    start and kind (k indexes KINDS), m the matched string."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select(
        "doc_id",
        F.filter(
            _spans(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 8
        ).alias("assign"),
        F.filter(_spans(text, ACCESS), lambda x: x["e"] - x["s"] >= 16).alias("access"),
        # Maximal runs under 32 characters fail, so only longer ones are asked for.
        _spans(text, HEX[:-1] + "{32,}").alias("hex"),
        _spans(text, CANDIDATE).alias("candidate"),
    )

    def tagged(name: str, k: int) -> Column:
        return F.transform(
            name, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), x["m"].alias("m"))
        )

    df = df.withColumn("base", F.concat(*[tagged(n, k) for k, n in enumerate(KINDS[:3])]))

    def secret(x: Column) -> Column:
        def random(v: Column) -> Column:
            bound = F.lit(-1)
            for c in reversed(CLASSES):
                bound = F.when(v.rlike(c.pattern), c.max_sum).otherwise(bound)
            return least_sum(v) <= bound

        parts = F.filter(F.split(x["m"], "/"), lambda v: (F.length(v) >= WINDOW) & ~v.rlike(words))
        ok = F.when(x["m"].rlike(words), F.exists(parts, random)).otherwise(random(x["m"]))
        for pattern in allow:
            ok = ~x["m"].rlike(pattern) & ok
        return ~x["held"] & ok

    # A base span holds a candidate if the ends of the spans up to its start reach its end.
    every = F.array_sort(
        F.concat(
            F.transform("base", lambda x: F.struct(x["s"].alias("s"), F.lit(0).alias("c"), x["e"].alias("e"), F.lit("").alias("m"))),
            F.transform("candidate", lambda x: F.struct(x["s"].alias("s"), F.lit(1).alias("c"), x["e"].alias("e"), x["m"].alias("m"))),
        )
    )

    def judged(spans: Column) -> Column:
        reach = _running(spans, lambda x: F.when(x["c"] == 0, x["e"]).otherwise(0), lambda a, x: F.greatest(a, x), F.lit(0))
        return F.zip_with(spans, reach, lambda x, r: x.withField("held", r >= x["e"]))

    df = df.withColumn("entropy", F.filter(F.filter(_with(every, judged), lambda x: x["c"] == 1), secret))
    return df.select("doc_id", F.array_sort(F.concat("base", tagged("entropy", 3))).alias("spans"))


def _text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))),
        ",",
    )


def _oracle() -> str:
    """The same rows by unnesting: every window of every candidate is counted
    anew, and all conditions are restated in SQL."""
    hexes = "[0-9a-f]{32,}"
    kinds = {"assign": ASSIGN.replace("'", "''"), "access": ACCESS, "hex": hexes, "cand": CANDIDATE}
    spans = " UNION ALL ".join(
        f"""SELECT rid, '{k}' AS kind, {i} AS k, unnest(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
              s := coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0)::BIGINT
                 + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT, m := m[i]))) AS x
            FROM (SELECT rid, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS b
                  FROM d WHERE regexp_matches(text, '{p}'))"""
        for i, (k, p) in enumerate(kinds.items())
    )
    logs = ", ".join(map(str, CLOGC[1:]))
    sql_patterns = [c.pattern for c in CLASSES]
    sql_patterns[1] = "[0-9].*[A-Za-z]|[A-Za-z].*[0-9]"  # no lookahead in RE2
    bound = " ".join(f"WHEN regexp_matches(v, '{p}') THEN {c.max_sum}" for c, p in zip(CLASSES, sql_patterns, strict=True))
    allow = " AND ".join(
        [f"NOT regexp_matches(m, '{p}')" for p in ALLOW[:2]] + ["NOT length(replace(m, m[1], '')) = 0"]
    )
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
      r AS (SELECT rid, kind, k, x.s AS s, x.s + length(x.m) AS e, x.m AS m FROM ({spans})),
      base AS (SELECT * FROM r WHERE kind = 'hex' OR (kind = 'access' AND e - s >= 16)
        OR (kind = 'assign' AND length(regexp_extract(m, '{kinds["assign"]}', 2)) >= 8)),
      parts AS (SELECT DISTINCT m, unnest(CASE WHEN regexp_matches(m, '{WORDS}')
          THEN list_filter(string_split(m, '/'), lambda v: length(v) >= {WINDOW} AND NOT regexp_matches(v, '{WORDS}')) ELSE [m] END) AS v
        FROM r WHERE kind = 'cand'),
      w AS (SELECT DISTINCT v, substr(v, i, {WINDOW}) AS w
            FROM (SELECT DISTINCT v, unnest(range(1, length(v) - {WINDOW} + 2)) AS i FROM parts)),
      sums AS (SELECT v, w, sum([{logs}][c]) AS t FROM (
            SELECT v, w, ch, count(*) AS c FROM (SELECT v, w, unnest(string_split(w, '')) AS ch FROM w) GROUP BY ALL)
            GROUP BY ALL),
      random AS (SELECT v FROM sums GROUP BY v HAVING min(t) <= CASE {bound} END),
      hit AS (SELECT DISTINCT m FROM parts WHERE v IN (SELECT v FROM random) AND {allow}),
      extra AS (SELECT * FROM r WHERE kind = 'cand' AND m IN (SELECT m FROM hit)
        AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = r.rid AND b.s <= r.s AND r.e <= b.e)),
      spans AS (SELECT rid, s, k, kind || ':' || s || ':' || e AS t, TRUE AS is_base FROM base
        UNION ALL SELECT rid, s, k, 'entropy:' || s || ':' || e, FALSE FROM extra),
      g AS (SELECT rid, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h,
        coalesce(string_agg(t, ',' ORDER BY s, k) FILTER (is_base), '') AS base,
        string_agg(t, ',' ORDER BY s, k) AS spans FROM spans GROUP BY rid)
      SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)"""


@register("op9_secret_scan", _oracle())
def q_secrets(spark, sf_dir):
    found = scan(documents(spark, sf_dir, "doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_text(F.filter("spans", lambda x: x["k"] < 3)), 256).alias("base_sha256"),
        _text(F.col("spans")).alias("spans"),
    )
