"""URL filtering by rules and by trust that spreads over the graph of hosts.

Pages that a rule allows are seeds of trust, pages that a rule blocks are seeds of
distrust. Trust follows links (personalised PageRank from the trusted hosts); distrust
goes against them: who links to a blocked host is suspect. Both run on links counted per
pair of hosts, so the size of a host does not matter. A host is blocked when its distrust
outweighs its trust.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table, next_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DAMPING = 0.85
ROUNDS = 20

# Rounds between two stored states. Adaptive execution plans and describes all of a plan anew after each of its stages,
# so what the driver does and holds for a plan grows with the square of its rounds.
STORED_EVERY = 2

# Scores are settled when those of a kind are within this of their limits, in sum; a kind's sum is 1 at most.
SETTLED = 1e-6

# Links of a host that one task follows in a round; a host with more is dealt to several.
SLOT_LINKS = 100_000

# Decimals of the difference of two scores that decide: sums in another order differ beyond them.
DECIMALS = 12

# A name longer than this is no host; only its direct parent counts.
LONGEST_HOST = 253

# Absolute links: host of href="scheme://host/..." and href="//host/...".
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""

Rule = tuple[str, str, str]  # host, path prefix, verdict


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule (struct of ``rule``, ``verdict``) for a host or its parents and a path."""
    found = []
    for name, prefix, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        found.append(F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))))
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*found, nothing)


def parent_links(hosts: DataFrame) -> DataFrame:
    """``src``, ``dst``: each host of ``hosts(host)`` and each domain above it with its direct parent.

    Domains need no pages; the last is the one with two labels, as a single label (``com``) is no site.
    Numbers are no names and have no parents.
    """
    name = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(name) - 2),
        lambda i: F.struct(
            F.array_join(F.slice(name, i, F.size(name)), ".").alias("src"),
            F.array_join(F.slice(name, i + 1, F.size(name)), ".").alias("dst"),
        ),
    )
    named = hosts.filter((F.length("host") <= LONGEST_HOST) & (F.size(name) > 2) & ~F.col("host").rlike(r"\.[0-9]+(:[0-9]*)?$"))
    pairs = named.select(F.explode(above).alias("pair")).select("pair.src", "pair.dst")
    return pairs.filter("src != '' AND dst != ''").distinct()


def host_links(pages: DataFrame, whole: bool = False) -> DataFrame:
    """``src``, ``dst``, ``links``: links between different hosts of ``pages(host, html)``.

    Links to hosts without pages are left out. A host and the host it is a direct
    subdomain of, if both have pages, count as linked once each way. With ``whole``, hosts
    without pages stay, and so do all domains above a host (``parent_links``).
    """
    outward = (
        pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("to"))
        .select("src", lower_ascii(F.col("to")).alias("dst"))
        .filter("src != dst AND src != ''")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("links"))
    )
    hosts = pages.filter("host != ''").select("host").distinct()
    up = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]*\.(.+)$", 1).alias("dst"))
    sites = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("links", F.lit(1).cast("long"))
    if whole:
        outward = as_table(outward, "outward")
        up = parent_links(hosts.union(outward.select("dst")).distinct())
        # The direct parent of a host may have one label only if it has pages.
        direct = sites.join(hosts.select(F.col("host").alias("src")), "src", "left_semi")
        direct = direct.join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi").select("src", "dst")
        pairs = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).unionByName(direct)
        known = outward.unionByName(pairs.distinct().withColumn("links", F.lit(1).cast("long")))
        return known.groupBy("src", "dst").agg(F.sum("links").alias("links"))
    known = outward.unionByName(sites).join(hosts.select(F.col("host").alias("src")), "src", "left_semi")
    known = known.join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi")
    return known.groupBy("src", "dst").agg(F.sum("links").alias("links"))


def rounds_to(settled: float) -> int:
    """Rounds after which scores are within ``settled`` of their limits: each shrinks what is open, at most 2, by ``DAMPING``."""
    return max(1, math.ceil(math.log(settled / 2) / math.log(DAMPING)))


def _shares(links: DataFrame, slot_links: int) -> DataFrame:
    """``links`` as the share of its source's score that each takes, dealt into slots.

    A host has a slot per ``slot_links`` links; ``slots`` is the number of slots of the
    target, as a source.
    """
    of_host = links.groupBy("kind", "src").agg(
        F.sum("links").alias("all_links"), F.ceil(F.count(F.lit(1)) / slot_links).cast("int").alias("of_src")
    )
    # Stored, so that the joins can split a domain with very many hosts.
    of_host = as_table(of_host, "totals")
    dealt = links.join(of_host, ["kind", "src"]).select(
        "kind",
        "src",
        F.pmod(F.xxhash64("dst"), F.col("of_src")).cast("int").alias("slot"),
        "dst",
        (F.col("links") / F.col("all_links")).alias("share"),
    )
    of_target = of_host.select("kind", F.col("src").alias("dst"), F.col("of_src").alias("slots"))
    return dealt.join(of_target, ["kind", "dst"], "left").select("kind", "src", "slot", "dst", "share", "slots")


def spread(
    seeds: DataFrame, links: DataFrame, rounds: int = ROUNDS, settled: float | None = None, slot_links: int = SLOT_LINKS
) -> DataFrame:
    """Personalised PageRank of several kinds at once.

    ``seeds(kind, host, weight)`` has weights that sum to one per kind, ``links(kind,
    src, dst, links)`` the graph of each kind. Returns ``kind``, ``host``, ``score``: after
    each round, a share of ``1 - DAMPING`` returns to the seeds and the rest follows the links in
    proportion; a host without links keeps nothing. With ``settled`` there are as many rounds as
    bring the scores of each kind within that of their limits, in sum.
    """
    rounds = rounds if settled is None else rounds_to(settled)
    shares = as_table(_shares(links, slot_links), "shares")
    of_seed = shares.groupBy("kind", F.col("src").alias("host")).agg((F.max("slot") + 1).alias("slots"))
    seeds = as_table(seeds.join(of_seed, ["kind", "host"], "left").select("kind", "host", "weight", "slots"), "seeds")
    base = seeds.select("kind", "host", "slots", (F.col("weight") * (1 - DAMPING)).alias("score"))
    state = seeds.select("kind", "host", "slots", F.col("weight").alias("score"))
    stored = None
    for done in range(1, rounds + 1):
        # A score goes to each slot of its host; hosts without links have none.
        slots = F.explode(F.sequence(F.lit(0), F.col("slots") - 1))
        given = state.filter("slots > 0").select("kind", F.col("host").alias("src"), slots.alias("slot"), "score")
        moved = given.join(shares, ["kind", "src", "slot"]).select(
            "kind", F.col("dst").alias("host"), "slots", (F.col("score") * F.col("share") * DAMPING).alias("score")
        )
        state = base.unionByName(moved).groupBy("kind", "host").agg(F.max("slots").alias("slots"), F.sum("score").alias("score"))
        if done % STORED_EVERY == 0 or done == rounds:
            state, stored = next_table(state, "ranks", stored)
    return state.select("kind", "host", "score")


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    tolerance: float = 1.0,
    whole: bool = False,
    settled: float | None = None,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust`` of every page.

    The longest rule that fits a url decides; else its host is blocked when its distrust
    is more than ``tolerance`` times its trust. With ``whole``, hosts without pages pass scores on
    (see ``host_links``); with ``settled``, scores spread until they are that near to their limits (see ``spread``). A url that is null or has no ``://`` has
    an empty host and path and is allowed, as is a host that neither reaches. A null page
    has no links. Rows with equal ids are judged each. Extra columns are ignored,
    whatever their names. An empty table gives an empty result.
    """
    read = pages.select(
        F.col(id_col).alias("page_id"),
        host_of(F.col(url_col).cast("string")).alias("host"),
        path_of(F.col(url_col).cast("string")).alias("path"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    ruled = read.withColumn("hit", fitting_rule(F.col("host"), F.col("path"), rules))
    links = as_table(host_links(read, whole), "host-links")
    counts = (
        ruled.filter("host != '' AND hit IS NOT NULL")
        .groupBy(F.when(F.col("hit.verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
        .agg(F.count(F.lit(1)).alias("pages"))
    )
    totals = counts.groupBy("kind").agg(F.sum("pages").alias("all_pages"))
    # Two rows, one per kind.
    seeds = counts.join(F.broadcast(totals), "kind").select(
        "kind", "host", (F.col("pages") / F.col("all_pages")).alias("weight")
    )
    both_ways = links.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    ranks = spread(seeds, both_ways, settled=settled)
    scores = ranks.groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    )
    # Stored, so that the join can split the pages of a large host.
    judged = ruled.drop("html").join(as_table(scores, "scores"), "host", "left")
    suspect = F.coalesce(F.round(F.col("distrust") - tolerance * F.col("trust"), DECIMALS) > 0, F.lit(False))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.when(suspect, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
