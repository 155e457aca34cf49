"""URL filters: rules first, then trust and distrust propagated over the host graph.

A rule (host, path) fits a url whose host is the rule's or a subdomain of it and whose path starts with the
rule's path; the longest fitting rule decides. Urls that no rule fits are judged by their host:

* edges: every absolute link of a page's html to another host, and each host to its parent domains and back;
* trust: personalised PageRank along the edges from the hosts of allowed pages;
* distrust: the same against the edges from the hosts of blocked pages, so that who links there is reached;
* a host is blocked when distrust d and trust t, each as a share of its seeds' sum, have d > 0 and
  d / (d + t) >= ``SHARE``: the more likely end of a walk from the blocked seeds than of one from the allowed, whatever
  the number of its pages. A host that no walk reaches is allowed.

Dangling hosts are not fed back: with restarts at the seeds that only scales all ranks alike. Everything is
DataFrame operations: edges are pre-aggregated, each step is one join on the source host and one sum, and
ranks are written to the shared folder every ``CUT`` steps.

Defined cases: a null url or one without ``://`` has an empty host and path, is fitted by no rule and allowed;
null html has no links; without seeds nothing is blocked by the method; repeated rows count as often as they
occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecall.llm.common import doc_columns, staged

#: The rules of the query, (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
DAMPING = 0.85
STEPS = 12
CUT = 4
SHARE = 0.5

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _AZ, _az)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest fitting rule, both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # a longer rule goes before all shorter ones
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, n) between different hosts."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
    links = links.select("src", F.translate("dst", _AZ, _az).alias("dst"))
    labels = F.split("host", "[.]")
    ups = F.transform(F.sequence(F.lit(1), F.size(labels) - 2), lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))
    parents = hosts.filter(F.size(labels) >= 3).select(F.col("host").alias("src"), F.explode(ups).alias("dst"))
    both = links.unionByName(parents).unionByName(parents.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return both.filter("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, steps: int = STEPS, damping: float = DAMPING) -> DataFrame:
    """kind, host, rank: restarts at the seeds (kind, host, seed); kind ``t`` follows the edges, ``d`` goes against them."""
    ways = edges.select(F.lit("t").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n").unionByName(
        edges.select(F.lit("d").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "n")
    )
    out = ways.groupBy("kind", "a").agg(F.sum("n").alias("all")).select(F.col("kind").alias("_kind"), F.col("a").alias("_a"), "all")
    ways = ways.join(out, (F.col("kind") == F.col("_kind")) & (F.col("a") == F.col("_a"))).select("kind", "a", "b", (F.lit(damping) * F.col("n") / F.col("all")).alias("p"))
    ways = staged(ways, "url-ways")
    start = seeds.select("kind", "host", (F.lit(1 - damping) * F.col("seed")).alias("rank"))
    ranks = start
    for step in range(1, steps + 1):
        r = ranks.select(F.col("kind").alias("_kind"), F.col("host").alias("_a"), "rank")
        moved = ways.join(r, (F.col("kind") == F.col("_kind")) & (F.col("a") == F.col("_a"))).select("kind", F.col("b").alias("host"), (F.col("p") * F.col("rank")).alias("rank"))
        ranks = start.unionByName(moved).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if step % CUT == 0:
            ranks = staged(ranks, f"url-ranks{step}")
    return ranks


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page's url."""
    rows = doc_columns(pages, "page_id", "url", "html")
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", "html", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    hosts = staged(
        ruled.filter("host <> ''").groupBy("host").agg(
            F.sum(F.when(F.col("by_rule") == "allow", 1).otherwise(0)).alias("allowed"), F.sum(F.when(F.col("by_rule") == "block", 1).otherwise(0)).alias("blocked"),
        ), "url-hosts",
    )
    seeds = hosts.filter("allowed > 0").select(F.lit("t").alias("kind"), "host", F.col("allowed").cast("double").alias("seed")).unionByName(
        hosts.filter("blocked > 0").select(F.lit("d").alias("kind"), "host", F.col("blocked").cast("double").alias("seed"))
    )
    ranks = propagate(_edges(rows, hosts), seeds)
    ranks = ranks.groupBy("host").agg(F.sum(F.when(F.col("kind") == "t", F.col("rank"))).alias("t"), F.sum(F.when(F.col("kind") == "d", F.col("rank"))).alias("d"))
    scored = hosts.select(F.col("host").alias("_host")).join(ranks.withColumnRenamed("host", "_h"), F.col("_host") == F.col("_h"), "left")
    scored = staged(scored.select("_host", F.round(F.coalesce("t", F.lit(0.0)), 9).alias("trust"), F.round(F.coalesce("d", F.lit(0.0)), 9).alias("distrust")), "url-scores")
    trusted, distrusted = hosts.agg(F.sum("allowed"), F.sum("blocked")).first()
    t, d = F.col("trust") / float(trusted or 1), F.col("distrust") / float(distrusted or 1)
    bad = (d > 0) & (d >= SHARE * (d + t))
    out = ruled.join(scored, F.col("host") == F.col("_host"), "left")
    method = F.when(bad, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def oracle_sql(rules: list[tuple[str, str, str]] = RULES) -> str:
    """The same rows in DuckDB SQL, one CTE for each step."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    case = lambda pick: "case " + " ".join(f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{pick(v, h, p)}'" for v, h, p in longest) + " end"
    link = _LINK.replace("'", "''")
    steps = []
    for i in range(1, STEPS + 1):
        steps.append(f"""r{i} as materialized (select kind, host, sum(rank) as rank from (select * from r0 union all
          select w.kind, w.b, w.p * r.rank from ways w join r{i - 1} r on w.kind = r.kind and w.a = r.host) group by 1, 2)""")
    return f"""
with u as (select page_id, html, case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end as rest from pages),
v as (select page_id, html, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_AZ}', '{_az}'), '') as host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from u),
ruled as (select page_id, html, host, path, {case(lambda v, h, p: h + p)} as rule, {case(lambda v, h, p: v)} as by_rule from v),
hosts as (select host, count(*) filter (by_rule = 'allow') as allowed, count(*) filter (by_rule = 'block') as blocked from ruled where host <> '' group by 1),
links as (select host as src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{_AZ}', '{_az}') as dst from v),
parts as (select host, string_split(host, '.') as l from hosts),
parents as (select host as src, unnest(list_transform(range(1, len(l) - 1), lambda i: array_to_string(l[i + 1:], '.'))) as dst from parts where len(l) >= 3),
edges as (select src, dst, count(*) as n from (select * from links union all select * from parents union all select dst, src from parents) where src <> dst and src <> '' and dst <> '' group by 1, 2),
both_ways as (select 't' as kind, src as a, dst as b, n from edges union all select 'd', dst, src, n from edges),
ways as materialized (select kind, a, b, {DAMPING} * n / sum(n) over (partition by kind, a) as p from both_ways),
r0 as materialized (select 't' as kind, host, {1 - DAMPING} * allowed::double as rank from hosts where allowed > 0 union all select 'd', host, {1 - DAMPING} * blocked::double from hosts where blocked > 0),
{", ".join(steps)},
s as (select host, sum(rank) filter (kind = 't') as t, sum(rank) filter (kind = 'd') as d from r{STEPS} group by 1),
scored as (select h.host, round(coalesce(t, 0), 9) as trust, round(coalesce(d, 0), 9) as distrust from hosts h left join s on h.host = s.host),
sums as (select greatest(sum(allowed), 1)::double as all_t, greatest(sum(blocked), 1)::double as all_d from hosts)
select page_id, ruled.host, path, rule, coalesce(by_rule, case when distrust > 0 and distrust / all_d >= {SHARE} * (distrust / all_d + trust / all_t) then 'block' else 'allow' end) as verdict,
  coalesce(trust, 0)::double as trust, coalesce(distrust, 0)::double as distrust
from ruled cross join sums left join scored on ruled.host = scored.host"""
