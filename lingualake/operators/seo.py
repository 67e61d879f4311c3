"""Slugs, routes, redirects and alternates of a localized site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import SECTIONS
from ..sources.tables import dealt, settled, settled_with


def slug_backfill(parents: DataFrame, rows: DataFrame, source: str = "en") -> DataFrame:
    """(_parent_id, _locale, slug): a source row for each parent, and its slug wherever a locale has none."""
    p = parents.select(F.col("id").alias("_parent_id"), F.col("slug").alias("parent_slug"))
    filled = rows.join(p, "_parent_id", "left").select("_parent_id", "_locale", F.coalesce("slug", "parent_slug").alias("slug"))
    have = rows.where(F.col("_locale") == source).select("_parent_id")
    new = p.join(have, "_parent_id", "left_anti").select("_parent_id", F.lit(source).alias("_locale"), F.col("parent_slug").alias("slug"))
    return filled.unionByName(new)


def slug_nulls(rows: DataFrame) -> DataFrame:
    """(_locale, n): rows without a slug, by locale."""
    return rows.where("slug IS NULL").groupBy("_locale").agg(F.count("*").alias("n"))


def slug_reverse(parents: DataFrame, rows: DataFrame, source: str = "en") -> DataFrame:
    """(id, slug) of the parents with their source row's slug back in place (of several the greatest; its own where there is none)."""
    back = rows.where(F.col("_locale") == source).groupBy(F.col("_parent_id").alias("id")).agg(F.max("slug").alias("back"))
    return parents.join(back, "id", "left").select("id", F.coalesce("back", "slug").alias("slug"))


def slug_conflicts(rows: DataFrame) -> DataFrame:
    return rows.where("slug IS NOT NULL").groupBy("_locale", "slug").agg(F.count("*").alias("n")).where("n > 1")


def localized_routes(docs: DataFrame, section: str, locales: list[str]) -> DataFrame:
    """(doc_id, lang, section_slug, slug, path) of each document in each locale but the source's."""
    pairs = F.array(*(F.struct(F.lit(lo).alias("lang"), F.lit(SECTIONS[section][lo]).alias("section_slug")) for lo in locales))
    rows = docs.select("doc_id", "slug", F.explode(pairs).alias("x")).select("doc_id", "x.lang", "x.section_slug", "slug")
    return rows.withColumn("path", F.concat_ws("/", F.lit(""), "lang", "section_slug", "slug"))


def route_collisions(routes: DataFrame) -> DataFrame:
    return routes.groupBy("path").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


def redirect_rules(routes: DataFrame, section: str, old_slugs: DataFrame | None = None) -> DataFrame:
    """(from_path, to_path): old forms of each route (source section under the locale, no locale) to the route.

    With old_slugs (doc_id, old_slug), what a document was once called leads to its route in every locale too.
    """
    old = F.array(F.concat_ws("/", F.lit(""), "lang", F.lit(section), "slug"), F.concat_ws("/", F.lit(""), "section_slug", "slug"), F.concat_ws("/", F.lit(""), "lang", "slug"))
    n = routes.count() * (3 if old_slugs is None else 4)
    rules = routes.select(F.explode(old).alias("from_path"), F.col("path").alias("to_path"))
    if old_slugs is not None:
        named = dealt(routes, n, "doc_id").join(dealt(old_slugs.select("doc_id", "old_slug"), n, "doc_id").hint("merge"), "doc_id")
        rules = rules.unionByName(named.select(F.concat_ws("/", F.lit(""), "lang", "section_slug", "old_slug").alias("from_path"), F.col("path").alias("to_path")))
    return dealt(rules.where("from_path <> to_path"), n, "from_path").groupBy("from_path").agg(F.min("to_path").alias("to_path"))


def chain_ends(hop: DataFrame, stops: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(at, root, depth, gate) of the hops (at, next; one for each at) whose chain ends, at a node without a hop or at one of stops (at);
    and (at, to) of those that lead into a circle, to being some hops on (None: there are none).

    root is the chain's end, depth the hops to it, gate the last node before it.
    Each round makes pointers three times as long, so the rounds grow with the logarithm of the longest chain. A round that ends no
    chain is the last: were there longer ones, one of the lengths it covers would have ended.
    """
    inner = hop if stops is None else hop.join(stops.select("at"), "at", "left_anti")
    starts = inner.select(F.col("at").alias("next"), F.lit(False).alias("last"))
    open_ends = F.count_if(~F.col("last"))
    step, left = settled_with(inner.join(starts, "next", "left").select("at", F.col("next").alias("to"), F.col("last").isNull().alias("last"), F.lit(1).cast("long").alias("n"), F.col("at").alias("gate")), open_ends)
    done, live, before = step.where("last"), step.where("NOT last"), None
    while left and left != before:
        jumps = done.unionByName(live).select(F.col("at").alias("to"), F.col("to").alias("far"), F.col("last").alias("final"), F.col("n").alias("more"), F.col("gate").alias("door"))
        step = live.join(jumps, "to").select("at", F.col("far").alias("to"), F.col("final").alias("last"), (F.col("n") + F.col("more")).alias("n"), F.col("door").alias("gate"))
        again = step.join(jumps, "to", "left").where("last OR final IS NOT NULL")
        moved = {"to": "far", "last": "final", "gate": "door"}
        step = again.select("at", *(F.when(F.col("last"), F.col(c)).otherwise(F.col(m)).alias(c) for c, m in moved.items()), F.when(F.col("last"), F.col("n")).otherwise(F.col("n") + F.col("more")).alias("n"))
        before = left
        step, left = settled_with(step, open_ends)
        done, live = done.unionByName(step.where("last")), step.where("NOT last")
    return done.select("at", F.col("to").alias("root"), F.col("n").alias("depth"), "gate"), live.select("at", "to") if left else None


def circles(hop: DataFrame, jump: DataFrame) -> DataFrame:
    """(at, label, pred) of the nodes of hop (at, next) that stand on a circle; every chain of hop leads into one. jump (at, to) says where
    each node gets in some number of hops, the same for all.

    What walks of that many hops, twice, four times as many can reach shrinks until it is the circles. On them a minimum is carried along with
    pointers that grow threefold until no window changes it: it names the circle. pred is the node before, on the circle.
    """
    size = jump.select("to").distinct().count()
    while True:
        far = jump.select(F.col("at").alias("to"), F.col("to").alias("far"))
        jump = settled(jump.join(far, "to").select("at", F.col("far").alias("to")))
        now = jump.select("to").distinct().count()
        if now == size:
            break
        size = now
    on = hop.join(jump.select(F.col("to").alias("at")).distinct(), "at", "left_semi")
    step = settled(on.select("at", F.col("next").alias("to"), F.col("at").alias("label"), F.col("next").alias("after")))
    while True:
        far = step.select(F.col("at").alias("to"), F.col("to").alias("far"), F.col("label").alias("other"))
        once = step.join(far, "to").select("at", F.col("far").alias("to"), "label", F.least("label", "other").alias("least"), "after")
        twice = once.join(far, "to").select("at", F.col("far").alias("to"), F.least("least", "other").alias("least"), "label", "after")
        step, less = settled_with(twice.select("at", "to", F.col("least").alias("label"), "after", (F.col("least") < F.col("label")).alias("less")), F.count_if("less"))
        if not less:
            break
    return step.select("at", "label").join(step.select(F.col("after").alias("at"), F.col("at").alias("pred")), "at")


def _before(ask: DataFrame, hop: DataFrame) -> DataFrame:
    """(from_path, to_path, stop) of the queries (from_path, to_path, steps) for which `from` stands steps + 1 hops behind `to`: stop is
    the node before it. One join for each bit of the steps."""
    ask, most = settled_with(ask.distinct().withColumn("cur", F.col("to_path")), F.max("steps"))
    jump, bit = hop.select("at", F.col("next").alias("to")), 1
    while bit <= (most or 0):
        moved = ask.join(jump, F.col("cur") == F.col("at"), "left")
        ask = settled(moved.select("from_path", "to_path", "steps", F.when(F.col("steps").bitwiseAND(bit) != 0, F.col("to")).otherwise(F.col("cur")).alias("cur")))
        jump = settled(jump.join(jump.select(F.col("at").alias("to"), F.col("to").alias("far")), "to").select("at", F.col("far").alias("to")))
        bit *= 2
    found = ask.join(hop, F.col("cur") == F.col("at")).where(F.col("next") == F.col("from_path"))
    return found.select("from_path", "to_path", F.col("cur").alias("stop"))


def flatten_redirects(edges: DataFrame) -> DataFrame:
    """(from_path, to_path): each redirect to the end of its chain, a row for each row of edges.

    A walk stops before a node that it has stood on (its start included, its first target not), as does the reference rule; of
    several targets of a path the greatest is the one that others follow. Nothing walks hop by hop: chains end by doubling,
    and where a circle is reached, the place to stop is known from the chain's way into it:
    - the start is on that circle: the node before it, on the circle, or on the chain if it comes in right there;
    - the start is on the chain, behind the target: the node before it;
    - else the node before the chain's entry, or the target itself where that is on the circle.
    """
    hop = settled(edges.where("to_path IS NOT NULL AND from_path IS NOT NULL").groupBy(F.col("from_path").alias("at")).agg(F.max("to_path").alias("next")))
    trees, jump = chain_ends(hop)
    if jump is not None:
        rest = hop.join(jump.select("at"), "at", "left_semi")
        rings = settled(circles(rest, jump))
        trees = trees.unionByName(chain_ends(rest, rings)[0])
    else:
        rings = hop.limit(0).select("at", F.col("at").alias("label"), F.col("at").alias("pred"))

    def of(df: DataFrame, key: str, mark: str) -> DataFrame:
        return df.select(*(F.col(c).alias(key if c == "at" else f"{mark}_{c}") for c in df.columns))

    e = edges.select("from_path", "to_path").join(of(trees, "to_path", "t"), "to_path", "left").join(of(trees, "from_path", "f"), "from_path", "left")
    e = e.join(of(rings, "to_path", "tr"), "to_path", "left").join(of(rings, "from_path", "fr"), "from_path", "left").join(of(rings, "t_root", "e"), "t_root", "left")
    back = (F.col("t_root") == F.col("f_root")) & (F.col("t_depth") > F.col("f_depth"))
    before = _before(e.where(back).select("from_path", "to_path", (F.col("t_depth") - F.col("f_depth") - 1).alias("steps")), hop)
    e = e.join(before, ["from_path", "to_path"], "left")
    into = F.coalesce("tr_label", "e_label")  # the circle that the walk reaches
    at_door = F.col("t_root") == F.col("from_path")
    end = F.when(F.col("fr_label") == into, F.when(at_door, F.col("t_gate")).otherwise(F.col("fr_pred")))
    end = end.when(F.col("stop").isNotNull(), F.col("stop")).when(F.col("e_label").isNotNull(), F.col("e_pred"))
    return e.select("from_path", end.when(F.col("t_root").isNotNull(), F.col("t_root")).otherwise(F.col("to_path")).alias("to_path"))


def alternates(pages: DataFrame) -> DataFrame:
    """(doc_id, alternates): locale to URL of each document, x-default being the source's."""
    rows = pages.select("doc_id", F.explode(F.when(F.col("lang") == "en", F.array(F.lit("en"), F.lit("x-default"))).otherwise(F.array("lang"))).alias("lang"), "url")
    return rows.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "url")))).alias("alternates"))


def head_links(pages: DataFrame) -> DataFrame:
    """(doc_id, lang, canonical, alternates) of each page: its own URL without trailing slash, and its document's alternates."""
    clean = pages.withColumn("url", F.regexp_replace("url", r"/+\z", ""))
    return clean.select("doc_id", "lang", F.col("url").alias("canonical")).join(alternates(clean), "doc_id")


def sitemap(pages: DataFrame) -> DataFrame:
    """(loc, lang, href): every URL, without trailing slash, with each alternate of its document."""
    clean = pages.withColumn("url", F.regexp_replace("url", r"/+\z", ""))
    each = alternates(clean).select("doc_id", F.explode("alternates").alias("lang", "href"))
    return clean.select("doc_id", F.col("url").alias("loc")).join(each, "doc_id").select("loc", "lang", "href")
