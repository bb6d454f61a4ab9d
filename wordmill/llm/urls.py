"""URL filters: fixed rules, then a path-template tree judged by label purity.

Urls that a rule decides are the labelled ones. Per host, the distinct paths form
a tree of segments, in which a segment that looks like a value (digits, long hex)
is ``*``. A shape is a distinct (host, segments); it carries the number of its
distinct labelled urls and of the blocked ones among them. Repeated rows change no
count. The tree grows in rounds, all nodes of all hosts at a time:

1. What all shapes of a node have in common ahead (a chain of only children, or
   the rest of a lone shape) is one step, so the rounds follow the number of
   branchings on a path, not its length.
2. A node with many children of few shapes each is variable: its children are
   one branch ``*``.
3. Siblings merge that are statistically similar: those with MIN_LABELS labelled
   urls or more set the blocked share of the side on which they lie (one half or
   more blocked, or less), and labelled siblings of that lean join whose share
   passes a z test against it.
4. A branch without labels joins the side whose remaining paths are most like its
   own (Jaccard index of SIMILAR or more against the siblings with MIN_LABELS; a
   variable next segment counts as ``*``). If both sides are as near, or no
   sibling has that many labels, it stays alone.

A leaf's template is rejected if it has MIN_LABELS labelled urls and the lower
confidence bound of its blocked share (Wilson's, which smooths towards one half)
reaches PURITY. Only labels of the leaf itself count: a few votes block nothing,
and neither do the labels of other hosts.

Hot hosts are summed map-side; every join has a unique right side, so a hot key
can be split.

Defined cases: a null url, or one without ``://``, has an empty host and path
and no rule; an empty path has the template ``/``; a path of any depth is one row,
worked in as many rounds as branchings lie on it; repeated rows each get their
result; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, read_table, scratch_path, stored
from .common import register

# The fixed rules of the query: (verdict, host and path).
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
MIN_CHILDREN = 10  # a node with so many children, and
MAX_PER_CHILD = 3  # at most so many shapes for each on average, is variable
MIN_LABELS = 9  # labelled urls that a merge or a verdict asks for
SIMILAR = 0.5  # Jaccard index from which an unlabelled branch joins a side
SURE = 1.645  # standard errors of the lower bound: 95 %, one-sided
PURITY = 0.75
VALUE = r"^[0-9]+(\..*)?$|^[0-9a-f-]{16,}$|[0-9].*[0-9].*[0-9].*[0-9]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(pages: DataFrame) -> DataFrame:
    """pages(page_id, url) -> page_id, host, path."""
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    df = pages.select("page_id", rest.alias("__rest"))
    df = df.withColumn("__host", F.regexp_extract("__rest", "^[^/?#]*", 0))
    path = F.regexp_extract(F.expr("substring(__rest, length(__host) + 1)"), "^[^?#]*", 0)
    return df.select("page_id", F.translate("__host", UPPER, LOWER).alias("host"), path.alias("path"))


def rule_of(rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits host and path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _segments() -> Column:
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike(VALUE), "*").otherwise(s))


def _common(lo: Column, hi: Column) -> Column:
    """Length of the common prefix of two arrays."""
    short = F.least(F.size(lo), F.size(hi))
    places = F.sequence(F.lit(0), short)
    return F.array_min(F.filter(places, lambda i: (i == short) | (F.get(lo, i) != F.get(hi, i))))


def _joining(at: DataFrame, children: DataFrame) -> DataFrame:
    """The branches without labels that join a side: host, template, seg, joins.
    Branches meet only through the rows of their side's distinct remaining
    paths, so siblings are never paired."""
    branch, side = ["host", "template", "seg"], ["host", "template", "side"]
    tails = at.select(*branch, F.get("rest", F.lit(1)).alias("next"), F.expr("slice(rest, 3, size(rest))").alias("tail"))
    below = tails.groupBy(*branch).agg(F.count_distinct("next").alias("d"), F.count("*").alias("all"))
    variable = (F.col("d") >= MIN_CHILDREN) & (F.col("all") <= F.col("d") * MAX_PER_CHILD)
    form = F.struct(F.when(variable & F.col("next").isNotNull(), "*").otherwise(F.col("next")).alias("next"), "tail")
    forms = tails.join(below, branch).select(*branch, F.to_json(form).alias("form")).distinct()
    forms = forms.join(children.select(*branch, "lab", "lean"), branch)
    pool = forms.where(F.col("lab") >= MIN_LABELS).select("host", "template", F.col("lean").alias("side"), "form").distinct()
    sizes = pool.groupBy(*side).agg(F.count("*").alias("size"))
    bare = forms.where("lab = 0").drop("lab", "lean")
    own = bare.groupBy(*branch).agg(F.count("*").alias("own"))
    shared = bare.join(pool, ["host", "template", "form"]).groupBy(*branch, "side").agg(F.count("*").alias("shared"))
    like = F.col("shared") / (F.col("own") + F.col("size") - F.col("shared"))
    scored = shared.join(sizes, side).join(own, branch).withColumn("like", like).where(F.col("like") >= SIMILAR)
    best = scored.groupBy(*branch).agg(
        F.max(F.when(F.col("side") == "+", F.col("like")).otherwise(0.0)).alias("bad"),
        F.max(F.when(F.col("side") == "-", F.col("like")).otherwise(0.0)).alias("good"),
    )
    return best.where("bad <> good").select(*branch, F.when(F.col("bad") > F.col("good"), "+").otherwise("-").alias("joins"))


def _branch_names(at: DataFrame) -> DataFrame:
    """at(host, template, rest, lab, blk), rest not empty -> host, template,
    seg, name: the branch that the child ``seg`` of a node becomes part of."""
    node, branch = ["host", "template"], ["host", "template", "seg"]
    lean = F.when(F.col("lab") > 0, F.when(F.col("blk") * 2 >= F.col("lab"), "+").otherwise("-"))
    children = cut_lineage(
        at.groupBy(*branch).agg(F.count("*").alias("n"), F.sum("lab").alias("lab"), F.sum("blk").alias("blk")).withColumn("lean", lean)
    )
    nodes = children.groupBy(*node).agg(F.count("*").alias("d"), F.sum("n").alias("all"))
    variable = (F.col("d") >= MIN_CHILDREN) & (F.col("all") <= F.col("d") * MAX_PER_CHILD)
    pools = (
        children.where(F.col("lab") >= MIN_LABELS).groupBy(*node, "lean").agg((F.sum("blk") / F.sum("lab")).alias("p"))
    )
    share = F.try_divide("blk", "lab")
    error = 2 * F.sqrt(F.try_divide(F.col("p") * (1 - F.col("p")), F.col("lab"))) + F.try_divide(F.lit(0.5), F.col("lab"))
    near = F.abs(share - F.col("p")) <= error
    sides = (
        children.join(pools, [*node, "lean"], "left")
        .join(_joining(at, children), branch, "left")
        .withColumn("side", F.coalesce("joins", F.when((F.col("lab") > 0) & near, F.col("lean"))))
        .select(*branch, "side")
    )
    members = sides.where("side IS NOT NULL").groupBy(*node, "side").agg(F.count("*").alias("members"))
    named = sides.join(nodes, node).join(members, [*node, "side"], "left")
    name = F.when(variable, "*").when(F.col("members") > 1, F.concat(F.lit("~"), F.col("side"))).otherwise(F.col("seg"))
    return named.select(*branch, name.alias("name"))


def templates(urls: DataFrame) -> DataFrame:
    """urls(host, path, segs, verdict) -> host, segs, template, labelled,
    blocked: the leaf of each distinct (host, segs), with the labelled urls of the
    whole leaf."""
    spark = urls.sparkSession
    distinct = urls.groupBy("host", "path").agg(F.first("segs").alias("segs"), F.first("verdict").alias("verdict"))
    live = stored(
        distinct.groupBy("host", "segs")
        .agg(F.count("verdict").alias("lab"), F.count_if(F.col("verdict") == "block").alias("blk"))
        .select("host", "segs", F.col("segs").alias("rest"), "lab", "blk", F.lit("/").alias("template")),
        "shapes",
    )
    ended = scratch_path(spark, "leaves")
    left = live.count()
    live.limit(0).drop("rest").write.parquet(ended)
    while left:
        # What a node's shapes share ahead is one step.
        ahead = live.groupBy("host", "template").agg(F.min("rest").alias("lo"), F.max("rest").alias("hi"))
        ahead = ahead.select("host", "template", _common(F.col("lo"), F.col("hi")).alias("skip"))
        step = F.concat(F.col("template"), F.array_join(F.transform(F.expr("slice(rest, 1, skip)"), lambda x: F.concat(x, F.lit("/"))), ""))
        moved = stored(
            live.join(ahead, ["host", "template"]).select(
                "host", "segs", F.expr("slice(rest, skip + 1, size(rest))").alias("rest"), "lab", "blk", step.alias("template")
            ),
            "moved",
        )
        moved.where(F.size("rest") == 0).drop("rest").write.mode("append").parquet(ended)
        at = moved.where(F.size("rest") > 0).withColumn("seg", F.get("rest", F.lit(0)))
        grown = at.join(_branch_names(at), ["host", "template", "seg"]).select(
            "host",
            "segs",
            F.expr("slice(rest, 2, size(rest))").alias("rest"),
            "lab",
            "blk",
            F.concat("template", "name", F.lit("/")).alias("template"),
        )
        live = stored(grown, "shapes")
        left = live.count()
    tree = spark.read.parquet(ended)
    leaves = tree.groupBy("host", "template").agg(F.sum("lab").alias("labelled"), F.sum("blk").alias("blocked"))
    return tree.select("host", "segs", "template").join(leaves, ["host", "template"])


def lower_bound(blocked: Column, labelled: Column) -> Column:
    """Wilson's lower bound of the blocked share; null without labels."""
    z2 = SURE * SURE
    spread = F.sqrt(F.try_divide(blocked * (labelled - blocked), labelled) + F.lit(z2 / 4))
    return F.when(labelled > 0, (blocked + F.lit(z2 / 2) - F.lit(SURE) * spread) / (labelled + F.lit(z2)))


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """pages(page_id, url) -> page_id, host, path, rule, template, purity (lower
    bound of the template's blocked share), verdict."""
    urls = parse(pages.select("page_id", "url"))
    rule, verdict = rule_of(rules)
    urls = urls.withColumns({"rule": rule, "verdict": verdict, "segs": _segments()})
    purity = lower_bound(F.col("blocked"), F.col("labelled"))
    leaves = templates(urls).select("host", "segs", "template", "labelled", purity.alias("purity"))
    bad = (F.col("labelled") >= MIN_LABELS) & (F.col("purity") >= PURITY)
    method = F.when(bad, "block").otherwise("allow")
    return urls.join(leaves, ["host", "segs"], "left").select(
        "page_id", "host", "path", "rule", "template", "purity", F.coalesce("verdict", method).alias("verdict")
    )


def _oracle() -> str:
    """The same tree as a recursive query, a round at a time."""
    fits = []
    for kind, text in sorted(RULES, key=lambda r: -len(r[1])):
        host, _, path = text.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", text, kind))
    case = lambda k: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[k]}'" for f in fits) + " END"
    some = f"{MIN_CHILDREN} AND every <= d * {MAX_PER_CHILD}"
    z2 = SURE * SURE
    return f"""WITH RECURSIVE
      r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
      h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h0 FROM r),
      p AS (SELECT page_id, translate(h0, '{UPPER}', '{LOWER}') AS host,
        regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path FROM h),
      u AS (SELECT *, {case(1)} AS rule, {case(2)} AS verdict,
        list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
          lambda s: CASE WHEN regexp_matches(s, '{VALUE}') THEN '*' ELSE s END) AS segs FROM p),
      t AS (
        SELECT host, segs, segs AS rest, count(verdict) AS lab, count(*) FILTER (verdict = 'block') AS blk, '/' AS template, true AS live
        FROM (SELECT DISTINCT host, path, segs, verdict FROM u) GROUP BY host, segs
      UNION ALL (
        WITH l AS (SELECT * FROM t WHERE live),
        g AS (SELECT host, template, coalesce(list_min(list_filter(range(least(len(lo), len(hi))), lambda i: lo[i + 1] <> hi[i + 1])),
            least(len(lo), len(hi))) AS skip
          FROM (SELECT host, template, min(rest) AS lo, max(rest) AS hi FROM l GROUP BY ALL)),
        m AS (SELECT host, segs, rest[skip + 1:] AS rest, lab, blk,
            template || array_to_string(list_transform(rest[:skip], lambda x: x || '/'), '') AS template
          FROM l JOIN g USING (host, template)),
        a AS (SELECT *, rest[1] AS seg FROM m WHERE len(rest) > 0),
        c AS (SELECT *, CASE WHEN lab > 0 THEN CASE WHEN blk * 2 >= lab THEN '+' ELSE '-' END END AS lean FROM (
          SELECT host, template, seg, count(*) AS n, sum(lab) AS lab, sum(blk) AS blk FROM a GROUP BY ALL)),
        s AS (SELECT *, rest[2] AS nxt, rest[3:] AS tail FROM a),
        b AS (SELECT host, template, seg, count(DISTINCT nxt) AS d, count(*) AS every FROM s GROUP BY ALL),
        f AS (SELECT DISTINCT host, template, seg, lab, lean, form FROM (
          SELECT s.host, s.template, s.seg, [coalesce(CASE WHEN d >= {some} AND nxt IS NOT NULL THEN '*' ELSE nxt END, '/')] || tail AS form
          FROM s JOIN b USING (host, template, seg)) JOIN (SELECT host, template, seg, lab, lean FROM c) USING (host, template, seg)),
        pool AS (SELECT DISTINCT host, template, lean AS side, form FROM f WHERE lab >= {MIN_LABELS}),
        size AS (SELECT host, template, side, count(*) AS size FROM pool GROUP BY ALL),
        own AS (SELECT host, template, seg, count(*) AS own FROM f WHERE lab = 0 GROUP BY ALL),
        sh AS (SELECT f.host, f.template, seg, side, count(*) AS shared FROM f JOIN pool USING (host, template, form)
          WHERE lab = 0 GROUP BY ALL),
        sc AS (SELECT host, template, seg, side, shared / (own + size - shared) AS alike FROM sh
          JOIN size USING (host, template, side) JOIN own USING (host, template, seg)),
        j AS (SELECT host, template, seg, CASE WHEN bad > good THEN '+' ELSE '-' END AS joins FROM (
          SELECT host, template, seg, max(CASE WHEN side = '+' THEN alike ELSE 0 END) AS bad,
            max(CASE WHEN side = '-' THEN alike ELSE 0 END) AS good FROM sc WHERE alike >= {SIMILAR} GROUP BY ALL) WHERE bad <> good),
        q AS (SELECT host, template, lean, sum(blk) / sum(lab) AS p FROM c WHERE lab >= {MIN_LABELS} GROUP BY ALL),
        sd AS (SELECT c.host, c.template, c.seg, c.n, coalesce(joins,
            CASE WHEN lab > 0 AND abs(blk / lab - p) <= 2 * sqrt(p * (1 - p) / lab) + 0.5 / lab THEN c.lean END) AS side
          FROM c LEFT JOIN q ON q.host = c.host AND q.template = c.template AND q.lean = c.lean
            LEFT JOIN j ON j.host = c.host AND j.template = c.template AND j.seg = c.seg),
        nm AS (SELECT host, template, seg, CASE WHEN d >= {some} THEN '*'
            WHEN side IS NOT NULL AND members > 1 THEN '~' || side ELSE seg END AS name
          FROM (SELECT *, count(*) OVER w AS d, sum(n) OVER w AS every, count(*) OVER (PARTITION BY host, template, side) AS members
            FROM sd WINDOW w AS (PARTITION BY host, template)))
        SELECT host, segs, rest, lab, blk, template, false FROM m WHERE len(rest) = 0
        UNION ALL
        SELECT a.host, a.segs, a.rest[2:], a.lab, a.blk, a.template || name || '/', true FROM a JOIN nm USING (host, template, seg))),
      l AS (SELECT host, template, sum(lab) AS n, sum(blk) AS b FROM t WHERE NOT live GROUP BY ALL),
      v AS (SELECT t.host, segs, n >= {MIN_LABELS} AND
          (b + {z2 / 2} - {SURE} * sqrt(b * (n - b) / n + {z2 / 4})) / (n + {z2}) >= {PURITY} AS bad
        FROM t JOIN l USING (host, template) WHERE NOT live)
      SELECT page_id, u.host, path, rule, coalesce(verdict, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
      FROM u LEFT JOIN v ON u.host = v.host AND u.segs = v.segs"""


@register("op10_url_filter", _oracle())
def q_urls(spark, sf_dir):
    return judge_urls(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
