"""Verdicts on URLs from a tree of path templates per host, in DataFrame functions only.

Rules for hosts and path prefixes judge first and are the labels of what is learned. Each host's
paths form a tree, and so do the paths of all hosts together. Level by level, below each template:

* a segment that is met fewer than ``LEAST_COUNT`` times is variable and becomes a wildcard, which
  keeps a file extension;
* segments whose labels don't differ significantly from their siblings' (two-proportion test) are
  similar and are merged into the wildcard too;
* where labels are missing on one side there is no evidence that branches are similar: a segment
  without labels among labelled siblings stays apart, and so does a labelled one among siblings
  without any.

The trees are as deep as counts carry: below a template that is met fewer than ``LEAST_COUNT`` times
all segments are wildcards. A template's purity is its share of allowed labels, smoothed towards that
of the template that the URL has in the tree of all hosts, which is smoothed towards ``NEUTRAL``.
Templates below ``LEAST_PURITY`` are rejected, so one that no label speaks against is not.

Defined results: a null URL, or one without ``://``, has an empty host and path. Every row comes back,
also rows with a repeated or null id; of rules of equal length the first in alphabetical order wins.
Counts are summed before anything is joined; a host with very many pages is one row per distinct path
then. Each round of a very deep path handles one level of those paths that still are frequent. Other
columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import pick, write_once

# (host, path prefix, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
LEAST_COUNT, Z_SQUARED = 5, 3.8416
WEIGHT, LEAST_PURITY, NEUTRAL = 5.0, 0.5, 0.5
SQL_LEVELS = 12  # of the counterpart SQL, which can't go on as long as counts carry
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_EXTENSION = "\\.[A-Za-z0-9]{1,5}\\z"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    mark = F.instr(url, "://")
    behind = F.when(mark > 0, F.substr(url, mark + 3))
    host = F.regexp_extract(behind, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(behind, F.length(host) + 1), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _ordered(rules) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))


def _first_rule(host: Column, path: Column, rules, pick_value) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for rule in _ordered(rules):
        name, prefix, _ = rule
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        out = out.when(fits, F.lit(pick_value(rule)))
    return out


def _wild(segment: Column) -> Column:
    """The wildcard of a segment; an empty one, of a slash at the end, is not variable."""
    return F.when(segment == "", "").otherwise(F.concat(F.lit("*"), F.regexp_extract(segment, _EXTENSION, 0)))


def _apart(n: Column, labels: Column, blocked: Column, all_labels: Column, all_blocked: Column) -> Column:
    """A segment stays itself: it is no variable, and nothing shows that it is like its siblings."""
    others, others_blocked = all_labels - labels, all_blocked - blocked
    gap = (blocked * others - others_blocked * labels).cast("double")
    spread = (all_blocked * (all_labels - all_blocked)).cast("double")
    differs = (gap != 0) & (
        gap * gap * all_labels >= Z_SQUARED * spread * labels.cast("double") * others.cast("double"))
    unknown = ((labels == 0) & (others > 0)) | ((labels > 0) & (others == 0))
    return (n >= LEAST_COUNT) & (differs | unknown)


def templates(urls: DataFrame) -> DataFrame:
    """(scope, host, path, template): of distinct (host, path, n, labels, blocked), within its host and,
    under the scope ``*``, within all hosts; with the template's labels ``t_labels`` and ``t_blocked``."""
    segments = F.filter(F.split("path", "/"), lambda x, i: i > 0)
    named = urls.withColumn("seg", segments)
    rows = named.withColumn("scope", F.explode(F.array(F.lit("h"), F.lit("*")))).select(
        F.when(F.col("scope") == "*", "*").otherwise(F.concat(F.lit("h"), "host")).alias("scope"),
        "host", "path", "n", "labels", "blocked", "seg", F.lit("").alias("template"))
    facts = ("n", "labels", "blocked")
    done, level = [], 0
    while True:
        level += 1
        rows = write_once(rows, "level")
        done.append(rows.filter(F.size("seg") < level).drop("seg"))
        rows = rows.filter(F.size("seg") >= level)
        if rows.isEmpty():
            break
        rows = rows.withColumn("s", F.element_at("seg", level))
        children = rows.groupBy("scope", "template", "s").agg(*(F.sum(c).alias(c) for c in facts))
        total = children.groupBy("scope", "template").agg(*(F.sum(c).alias(f"all_{c}") for c in facts))
        judged = children.join(total, ["scope", "template"]).select(
            "scope", "template", "s", _apart(*(F.col(c) for c in (*facts, "all_labels", "all_blocked"))).alias("apart"),
            (F.col("all_n") < LEAST_COUNT).alias("rare"))
        step = F.when(F.col("apart"), F.col("s")).otherwise(_wild(F.col("s")))
        # nothing below a rare template is frequent, so its rows need no further rounds
        end = F.array_join(F.transform(F.slice("seg", level, F.size("seg")), _wild), "/")
        rows = rows.join(judged, ["scope", "template", "s"]).select(
            "scope", "host", "path", *facts, F.when(~F.col("rare"), F.col("seg")).otherwise(F.array()).alias("seg"),
            F.concat("template", F.lit("/"), F.when(F.col("rare"), end).otherwise(step)).alias("template"))
    whole = write_once(reduce(DataFrame.unionByName, done), "templates")
    by_template = whole.groupBy("scope", "template").agg(
        F.sum("labels").alias("t_labels"), F.sum("blocked").alias("t_blocked"))
    return whole.select("scope", "host", "path", "template").join(by_template, ["scope", "template"])


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every row."""
    host, path = parts(F.col("url"))
    rows = pick(pages, page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path"))
    mark = _first_rule(F.col("host"), F.col("path"), rules, lambda r: r[2])
    label = F.when(mark == "block", 1).when(mark == "allow", 0)
    urls = write_once(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).select(
        "host", "path", "n", F.when(label.isNotNull(), F.col("n")).otherwise(0).alias("labels"),
        F.when(label == 1, F.col("n")).otherwise(0).alias("blocked")), "urls")
    found = templates(urls)

    def smoothed(prior: Column) -> Column:
        return (F.col("t_labels") - F.col("t_blocked") + WEIGHT * prior) / (F.col("t_labels") + WEIGHT)

    everywhere = found.filter(F.col("scope") == "*").select("host", "path", smoothed(F.lit(NEUTRAL)).alias("prior"))
    own = found.filter(F.col("scope") != "*").join(everywhere, ["host", "path"]).select(
        "host", "path", "template", smoothed(F.col("prior")).alias("purity"))
    rule = _first_rule(F.col("host"), F.col("path"), rules, lambda r: r[0] + r[1])
    return rows.join(own, ["host", "path"]).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(mark, F.when(F.col("purity") < LEAST_PURITY, "block").otherwise("allow")).alias("verdict"),
        "template", F.round("purity", 9).alias("purity"))


def oracle(rules=RULES, levels: int = SQL_LEVELS) -> str:
    """The same verdicts as DuckDB SQL, for paths of no more than ``levels`` segments."""
    def chain(index: int) -> str:
        cases = "".join(
            f" WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{prefix}')"
            f" THEN '{(verdict, name + prefix)[index]}'" for name, prefix, verdict in _ordered(rules))
        return f"CASE{cases} END"

    steps = ""
    for level in range(1, levels + 1):
        steps += f""",
s{level} AS (SELECT *, CASE WHEN len(seg) >= {level} THEN seg[{level}] END AS s FROM r{level - 1}),
c{level} AS (SELECT scope, template, s, sum(n) AS n, sum(labels) AS labels, sum(blocked) AS blocked
    FROM s{level} WHERE s IS NOT NULL GROUP BY ALL),
k{level} AS (SELECT scope, template, s FROM (SELECT *, labels::DOUBLE AS l, blocked::DOUBLE AS b,
        (sum(labels) OVER w)::DOUBLE AS al, (sum(blocked) OVER w)::DOUBLE AS ab
        FROM c{level} WINDOW w AS (PARTITION BY scope, template))
    WHERE n >= {LEAST_COUNT} AND ((l = 0 AND al > 0) OR (l > 0 AND al = l)
      OR (b * (al - l) - (ab - b) * l <> 0 AND (b * (al - l) - (ab - b) * l) * (b * (al - l) - (ab - b) * l) * al
        >= {Z_SQUARED}::DOUBLE * (ab * (al - ab)) * l * (al - l)))),
r{level} AS (SELECT a.* EXCLUDE (s, template), a.template || CASE WHEN a.s IS NULL THEN '' ELSE '/' || CASE
        WHEN k.s IS NOT NULL OR a.s = '' THEN a.s
        ELSE '*' || regexp_extract(a.s, '{_EXTENSION}') END END AS template
    FROM s{level} a LEFT JOIN k{level} k ON a.scope = k.scope AND a.template = k.template AND a.s = k.s)"""
    return f"""WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) END AS behind FROM pages),
h AS (SELECT page_id, behind, regexp_extract(behind, '^[^/?#]*') AS raw FROM p),
rows AS (SELECT page_id, coalesce(translate(raw, '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(substr(behind, length(raw) + 1), '^[^?#]*'), '') AS path FROM h),
marked AS (SELECT *, {chain(0)} AS mark, {chain(1)} AS rule FROM rows),
urls AS (SELECT host, path, count(*) AS n, count(mark) AS labels, count(*) FILTER (mark = 'block') AS blocked
    FROM marked GROUP BY ALL),
r0 AS (SELECT CASE WHEN scope = '*' THEN '*' ELSE 'h' || host END AS scope, host, path, n, labels, blocked,
    string_split(path, '/')[2:] AS seg, '' AS template FROM urls, (VALUES ('h'), ('*')) v(scope)){steps},
t AS (SELECT scope, template, sum(labels)::DOUBLE AS l, sum(blocked)::DOUBLE AS b FROM r{levels} GROUP BY ALL),
f AS (SELECT r.scope, r.host, r.path, r.template, t.l, t.b FROM r{levels} r JOIN t USING (scope, template)),
e AS (SELECT host, path, (l - b + {WEIGHT * NEUTRAL}::DOUBLE) / (l + {WEIGHT}::DOUBLE) AS prior FROM f WHERE scope = '*'),
o AS (SELECT f.host, f.path, f.template, (l - b + {WEIGHT}::DOUBLE * prior) / (l + {WEIGHT}::DOUBLE) AS purity
    FROM f JOIN e USING (host, path) WHERE scope <> '*')
SELECT page_id, host, path, rule, coalesce(mark, CASE WHEN purity < {LEAST_PURITY}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
    template, round(purity, 9) AS purity FROM marked JOIN o USING (host, path)"""
