"""URL filters by rules and link-graph propagation (operator 8, DataFrame
functions only).

Rules (host, path) decide first: a rule fits its host and all subdomains when
the url's path starts with the rule's; the longest wins. The rest is judged by
host. Links between hosts are read from the ``href`` attributes of the pages and
aggregated to weighted host edges. Trust is the personalised PageRank from the
hosts of which allow rules decide most pages; distrust is the same on reversed
edges from the hosts of which block rules decide most pages (whoever links to a
blocked host inherits its distrust). Both scores sum to one over all hosts, so a
host's own shrink as a table grows; for the verdict they are multiplied by the
pages of their seeds. A host is blocked when its distrust exceeds its trust by
more than the part ``THRESHOLD`` of their sum, however small both are; a host
without evidence is allowed. Mass travels ``MAX_TURNS`` links at most.

Defined results: a null url, or one without ``://``, has an empty host and path,
no rule and the verdict ``allow``; a null html has no links. Repeated rows keep
their own result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payledger.llm.common import stored
from payledger.llm.decontaminate import LOWER, UPPER

# Verdict, host, path of every rule.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING, THRESHOLD, TOLERANCE, MAX_TURNS = 0.85, 1e-4, 1e-6, 10_000
SALTS = 64


def _after_scheme(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substr(u, at + 3)).otherwise("")


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, weight``: links from a page of one host to another host."""
    html = F.coalesce(F.col("html"), F.lit(""))
    links = F.regexp_extract_all(html, F.lit(r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)"""), 1)
    links = F.transform(links, lambda x: F.when(F.startswith(x, F.lit("//")), F.concat(F.lit("http:"), x)).otherwise(x))
    pairs = pages.select(url_host(F.col("url")).alias("src"), F.explode(links).alias("link")).select("src", url_host(F.col("link")).alias("dst"))
    return pairs.where("src != '' AND dst != '' AND src != dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, name: str) -> DataFrame:
    """Personalised PageRank ``host, score`` over ``edges(src, dst, weight)`` from
    ``seeds(host, mass)``, whose masses sum to 1. Each turn is a join and a
    partial aggregate whose result is written; only the largest change of a host
    in proportion to its score, however small that is, comes to the driver: turns end when
    no host is new and none changes by more than ``TOLERANCE``. Mass of a host without links
    returns to the seeds. ``MAX_TURNS`` without an end is an error."""
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    steps = stored(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("p")), name)
    score = seeds.select("host", F.col("mass").alias("score"))
    for _ in range(MAX_TURNS):
        moved = score.join(steps, score["host"] == steps["src"]).select(F.col("dst").alias("host"), (F.col("score") * F.col("p") * DAMPING).alias("x"))
        kept = seeds.select("host", (F.col("mass") * (1 - DAMPING)).alias("x"))
        new = stored(moved.union(kept).groupBy("host").agg(F.sum("x").alias("score")), name)
        both = new.select("host", F.col("score").alias("x"), F.col("score").alias("now")).union(
            score.select("host", (-F.col("score")).alias("x"), F.lit(0.0).alias("now")))
        change = both.groupBy("host").agg((F.abs(F.sum("x")) / F.sum("now")).alias("x")).agg(F.max("x")).first()[0] or 0.0
        score = new
        if change < TOLERANCE or steps.isEmpty():
            return score
    raise RuntimeError(f"{name}: no fixed point after {MAX_TURNS} turns")


def host_scores(pages: DataFrame, rules=RULES) -> DataFrame:
    """``host, trust, distrust, lean`` of every host that a seed reaches; ``lean``
    is the excess of distrust over trust, in pages of seeds, by their sum."""
    judged = pages.select(url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    _, verdict = rule_of(F.col("host"), F.col("path"), rules)
    tally = stored(judged.select("host", verdict.alias("v")).groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("v") == "allow").alias("allow"), F.count_if(F.col("v") == "block").alias("block")), "seeds")
    edges = stored(host_edges(pages), "edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")

    def seeds(kind: str) -> tuple[DataFrame, float]:
        hosts = tally.where((F.col("host") != "") & (2 * F.col(kind) > F.col("pages")))
        total = float(hosts.agg(F.sum(kind)).first()[0] or 1)
        return hosts.select("host", (F.col(kind) / total).alias("mass")), total

    (good, n_good), (bad, n_bad) = seeds("allow"), seeds("block")
    trust = propagate(edges, good, "trust").withColumnRenamed("score", "trust")
    distrust = propagate(back, bad, "distrust").withColumnRenamed("score", "distrust")
    both = trust.join(distrust, "host", "full").select(
        "host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    plus, minus = F.col("trust") * n_good, F.col("distrust") * n_bad
    return both.withColumn("lean", F.try_divide(minus - plus, minus + plus))


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every row."""
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), salt.alias("salt"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "given": verdict})
    # a hot host's pages meet one copy of its score per salt
    scores = host_scores(pages, rules).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    out = rows.join(scores, ["host", "salt"], "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(F.col("lean") > THRESHOLD, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("given", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
