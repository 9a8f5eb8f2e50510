"""Judge urls by rules and, where none applies, by trust spread over host edges.

Trust is a personalised PageRank from the hosts of allowed pages; distrust is one on the reversed edges from
the hosts of blocked pages.  Edges are links from one host to another, counted, and a light pair of edges between a
host and its parent domain (of at least two labels), since who runs the one can run the other.  A host is blocked
where its distrust is above its trust.

Defined results: null or malformed urls have empty host and path, match no rule and are allowed; hosts that
neither score reaches are allowed; null html has no links; repeated pages count as often as they occur; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledger.llm.common import cut, lower_ascii, named

#: Rules in force: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING = 0.85
#: Rounds the SQL writes out; the operator goes on until the ranks are known.
ROUNDS = 12
#: Ranks are known when a bound on what is still to come is no more than this share of each.
TOLERANCE = 1e-6
PARENT_WEIGHT = 0.1
#: Attribute value of a link that names a host.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path``."""
    url = F.col("_url")
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(F.col("_rest"), r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(F.col("_rest"), F.length(host) + 1), r"^[^?#]*", 0)
    return (
        pages.withColumn("_rest", F.coalesce(rest, F.lit("")))
        .withColumn("path", path).withColumn("host", lower_ascii(host)).drop("_rest")
    )


def with_rule(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Add ``rule`` and ``ruled`` (its verdict): the longest rule that fits, null if none.

    The rules are an operator parameter, a list of bounded length that becomes one expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for ruled, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(ruled)).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("ruled", verdict)


def _parent(host: Column) -> Column:
    return F.when(F.size(F.split(host, r"\.")) > 2, F.regexp_extract(host, r"^[^.]*\.(.*)$", 1))


def host_edges(pages: DataFrame, parent_weight: float = PARENT_WEIGHT) -> DataFrame:
    """``_src``, ``_dst``, ``_weight``: links between hosts, and hosts tied to their parent domains."""
    links = (
        pages.select(F.col("host").alias("_src"), F.explode(F.regexp_extract_all("_html", F.lit(LINK), 1)).alias("_dst"))
        .withColumn("_dst", lower_ascii("_dst"))
        .filter((F.col("_src") != "") & (F.col("_src") != F.col("_dst")))
        .groupBy("_src", "_dst").agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    )
    links = cut(links, "url-links")
    hosts = (
        pages.select("host").distinct().union(links.select("_dst")).distinct()
        .filter(F.col("host") != "").withColumn("_up", _parent(F.col("host")))
    )
    # Domains of every length above a host: a chain of at most as many steps as it has labels.
    chain = F.transform(
        F.sequence(F.lit(0), F.size(F.split("host", r"\.")) - 3),
        lambda i: F.struct(
            F.array_join(F.slice(F.split("host", r"\."), i + 1, 1000), ".").alias("lower"),
            F.array_join(F.slice(F.split("host", r"\."), i + 2, 1000), ".").alias("upper")))
    ties = (
        hosts.filter(F.col("_up").isNotNull()).select(F.explode(chain).alias("_tie")).distinct()
        .select(F.explode(F.array(
            F.struct(F.col("_tie.lower").alias("_src"), F.col("_tie.upper").alias("_dst")),
            F.struct(F.col("_tie.upper").alias("_src"), F.col("_tie.lower").alias("_dst")))).alias("_edge"))
        .select("_edge._src", "_edge._dst", F.lit(parent_weight).alias("_weight"))
    )
    return links.union(ties).groupBy("_src", "_dst").agg(F.sum("_weight").alias("_weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of both kinds at once: ``_kind``, ``host``, ``_rank``.

    ``seeds`` has ``_kind``, ``host``, ``_seed`` summing to 1 per kind.  Kind ``trust`` follows the edges, kind ``distrust``
    their reverse.  What reaches a host without edges stays out of the next round; only comparisons of
    the two scores matter.

    Residuals are pushed: each round moves only what arrived in the round before, from the hosts where something did, and adds it to the
    ranks.  Two rounds make a step.  As nothing is negative, if a step turns every host's residual into between ``low`` and ``high``
    times itself, so does every later step: what is still to come then lies between geometric series of ``low`` and of ``high``.
    Steps end once the gap between both is at most ``tolerance`` of each rank, and the middle is added; or, where residuals circle so that no factor is found,
    once a step adds at most ``tolerance * (1 - damping) / damping`` of itself to each rank.  A host reached for the first
    time has no factor and grows by all of its rank, so every host that a path from a seed leads to has a score, however long the path.
    """
    both = edges.select(F.lit("trust").alias("_kind"), "_src", "_dst", "_weight").union(
        edges.select(F.lit("distrust"), F.col("_dst"), F.col("_src"), F.col("_weight")))
    out = both.groupBy("_kind", "_src").agg(F.sum("_weight").alias("_out"))
    steps = cut(
        both.join(out, ["_kind", "_src"])
        .select("_kind", "_src", F.col("_dst").alias("host"), (F.col("_weight") / F.col("_out") * damping).alias("_share")),
        "url-steps")

    def moved(rows: DataFrame) -> DataFrame:
        live = rows.filter(F.col("_new") > 0).select("_kind", F.col("host").alias("_src"), "_new")
        return (
            steps.join(live, ["_kind", "_src"])
            .groupBy("_kind", "host").agg(F.sum(F.col("_new") * F.col("_share")).alias("_new"))
        )

    start = F.col("_seed") * (1 - damping)
    ranks = cut(seeds.select("_kind", "host", start.alias("_rank"), start.alias("_new"), F.lit(0.0).alias("_mid")), "url-ranks")
    kinds = ("trust", "distrust")
    while True:
        zero, new = F.lit(0.0), F.col("_new")
        once = moved(ranks)
        parts = [
            ranks.select("_kind", "host", "_rank", new.alias("_old"), zero.alias("_mid"), zero.alias("_new")),
            once.select("_kind", "host", new.alias("_rank"), zero.alias("_old"), new.alias("_mid"), zero.alias("_new")),
            moved(once).select("_kind", "host", new.alias("_rank"), zero.alias("_old"), zero.alias("_mid"), new.alias("_new")),
        ]
        total = reduce(DataFrame.union, parts).groupBy("_kind", "host").agg(*[F.sum(c).alias(c) for c in ("_rank", "_old", "_mid", "_new")])
        # Both rounds of a step count: of the first round's arrivals only the next step could tell the factor.
        factor = F.when(F.col("_old") > 0, F.col("_new") / F.col("_old")).when(F.col("_new") > 0, F.lit(float("inf")))
        share = F.when(F.col("_rank") > 0, (F.col("_mid") + F.col("_new")) / F.col("_rank"))
        seen = Observation()
        ranks = cut(total.observe(seen, *[
            f(F.when(F.col("_kind") == kind, c)).alias(f"{name}_{kind}")
            for kind in kinds for name, f, c in (("low", F.min, factor), ("high", F.max, factor), ("share", F.max, share))
        ]), "url-ranks").drop("_old")
        found, tails, known = seen.get, {}, True
        for kind in kinds:
            low, high, left = (found[f"{name}_{kind}"] or 0.0 for name in ("low", "high", "share"))
            if not left:
                continue
            upper = high / (1 - high) if high < 1 else float("inf")
            lower = low / (1 - low) if low < 1 else 0.0
            # The arrivals of the first round follow those of the second at the same factors, one step on.
            known &= left * (upper - lower) <= tolerance or left * damping / (1 - damping) <= tolerance
            tails[kind] = (lower + upper) / 2 if upper < float("inf") else 0.0
        if known:
            tail = reduce(lambda c, kind: F.when(F.col("_kind") == kind, F.lit(tails[kind])).otherwise(c), tails, F.lit(0.0))
            return ranks.select("_kind", "host", (F.col("_rank") + (F.col("_mid") + F.col("_new")) * tail).alias("_rank"))


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    parsed = with_rule(with_host_and_path(
        pages.select(named("page_id").alias("page_id"), named("url").alias("_url"), named("html").alias("_html"))), rules)
    ruled = parsed.drop("_url", "_html")
    counts = (
        ruled.filter(F.col("ruled").isNotNull()).groupBy("ruled", "host").agg(F.count(F.lit(1)).alias("_n"))
        .select(F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("_kind"), "host", "_n")
    )
    totals = counts.groupBy("_kind").agg(F.sum("_n").alias("_all"))
    seeds = counts.join(totals, "_kind").select("_kind", "host", (F.col("_n") / F.col("_all")).alias("_seed"))
    ranks = propagate(host_edges(parsed), seeds)
    blocked = (
        ranks.groupBy("host").agg(
            F.coalesce(F.sum(F.when(F.col("_kind") == "trust", F.col("_rank"))), F.lit(0.0)).alias("_trust"),
            F.coalesce(F.sum(F.when(F.col("_kind") == "distrust", F.col("_rank"))), F.lit(0.0)).alias("_distrust"))
        .filter(F.col("_distrust") > F.col("_trust"))
        .select(F.col("host").alias("_host"))
    )
    blocked = cut(blocked, "url-blocked")
    return (
        ruled.join(blocked, F.col("host") == F.col("_host"), "left")
        .select("page_id", "host", "path", "rule",
                F.coalesce("ruled", F.when(F.col("_host").isNotNull(), "block").otherwise("allow")).alias("verdict"))
    )
