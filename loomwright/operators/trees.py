"""Taxonomies: closure tables, coverage, subject recall, beam routing, route acceptance, confidence calibration."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .graph import written


def flatten(tree) -> list[dict]:
    """Nodes (code, name, parent, depth, path) of a nested tree, a list of nested trees, a flat list under ``nodes`` with
    parent_code, or levels under ``hierarchy``. Unknown parents, cycles and repeated codes are errors. Trees are small
    settings, so this is driver work."""
    out: list[dict] = []

    def walk(n, parent, names, depth):
        n = {"name": n} if isinstance(n, str) else n
        name = n.get("name") or n.get("name_zh")
        if not isinstance(name, str) or not name:
            raise ValueError("node without a name")
        code = str(n.get("code") or n.get("node_code") or "/".join([*names, name]))
        out.append({"code": code, "name": name, "parent": parent, "depth": depth, "path": "/".join([*names, name])})
        for child in n.get("children") or n.get(f"l{depth + 1}_nodes") or []:
            walk(child, code, [*names, name], depth + 1)

    if isinstance(tree, dict) and "nodes" in tree:
        by = {str(n["node_code"]): n for n in tree["nodes"]}
        if len(by) != len(tree["nodes"]):
            raise ValueError("repeated code")
        for code, n in by.items():
            chain, at = [], code
            while at is not None:
                if at in chain:
                    raise ValueError(f"cycle at {at}")
                if at not in by:
                    raise ValueError(f"unknown parent {at}")
                chain.append(at)
                at = by[at].get("parent_code")
            names = [by[c]["name"] for c in reversed(chain)]
            out.append({"code": code, "name": n["name"], "parent": n.get("parent_code"), "depth": len(chain), "path": "/".join(names)})
    else:
        for n in tree if isinstance(tree, list) else tree.get("hierarchy") or [tree]:
            walk(n, None, [], 1)
    if len({n["code"] for n in out}) != len(out):
        raise ValueError("repeated code")
    return out


def nodes(spark: SparkSession, tree) -> DataFrame:
    return spark.createDataFrame([(n["code"], n["name"], n["parent"], n["depth"], n["path"]) for n in flatten(tree)], "code string, name string, parent string, depth int, path string")


def closure(tree: DataFrame, max_depth: int = 32) -> DataFrame:
    """(ancestor, node, distance) with every node its own ancestor, level by level."""
    step = tree.select(F.col("code").alias("ancestor"), F.col("code").alias("node"), F.lit(0).alias("distance"))
    out, up = step, tree.select(F.col("code").alias("_c"), F.col("parent").alias("_p"))
    for _ in range(max_depth):
        step = written(step.join(up, F.col("ancestor") == F.col("_c")).where("_p is not null").select(F.col("_p").alias("ancestor"), "node", (F.col("distance") + 1).alias("distance")))
        if step.isEmpty():
            return out
        out = out.unionByName(step)
    raise ValueError("tree too deep, or a cycle")


def leaves(tree: DataFrame) -> DataFrame:
    return tree.join(tree.select(F.col("parent").alias("code")), "code", "left_anti")


def ancestor_at(closed: DataFrame, tree: DataFrame, depth: int) -> DataFrame:
    """(node, ancestor) at a depth."""
    return closed.join(tree.where(F.col("depth") == depth).select(F.col("code").alias("ancestor")), "ancestor", "left_semi").select("node", "ancestor")


def sibling_groups(tree: DataFrame, size: int = 3) -> DataFrame:
    """Children of a node in groups of at most ``size``: (parent, group_no, codes)."""
    d = tree.where("parent is not null").withColumn("group_no", F.floor((F.row_number().over(W.partitionBy("parent").orderBy("code")) - 1) / size).cast("int"))
    return d.groupBy("parent", "group_no").agg(F.array_sort(F.collect_list("code")).alias("codes"))


def path_context(rows: DataFrame, tree: DataFrame, path: str) -> DataFrame:
    """Rows with the exact node of their path, its ancestors' names and its children's; a missing path is flagged."""
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("code")).agg(F.array_sort(F.collect_list("name")).alias("children"))
    t = tree.join(kids, "code", "left").select(F.col("path").alias("_path"), "depth", F.split("path", "/").alias("path_names"), F.coalesce("children", F.array().cast("array<string>")).alias("children"))
    j = rows.join(t, F.col(path) == F.col("_path"), "left")
    return j.withColumn("path_exists", F.col("_path").isNotNull()).drop("_path")


def recall(df: DataFrame, subject_fields: list[str], title: str, other_fields: list[str], config: dict[str, list]) -> DataFrame:
    """Adds ``recall``: struct<strength, channel, terms>, by the first channel that holds.

    config: direct, adjacent, strong, weak, exclude (lists of terms), groups (lists of terms that must all be there).
    Direct subject and strong title hits stand whatever is excluded; the weaker channels do not."""
    norm = lambda c: F.trim(F.lower(T.blank(F.col(c))))
    subject = F.concat_ws("\n", *[norm(c) for c in subject_fields])
    ttl, other = norm(title), F.concat_ws("\n", *[norm(c) for c in other_fields])
    every = sorted({t for k in ("direct", "adjacent", "strong", "weak", "exclude") for t in config.get(k, [])} | {t for g in config.get("groups", []) for t in g})
    d = df.withColumn("_s", T.term_hits(subject, every)).withColumn("_t", T.term_hits(ttl, every)).withColumn("_o", T.term_hits(other, every))
    among = lambda c, k: F.array_sort(F.array_intersect(c, F.array(*map(F.lit, config.get(k, []))).cast("array<string>")))
    s, t, o = F.col("_s"), F.col("_t"), F.col("_o")
    meta, all_ = F.array_union(s, o), F.array_union(F.array_union(s, t), o)
    excluded = F.size(among(all_, "exclude")) > 0
    group = F.array().cast("array<string>")
    for g in reversed(config.get("groups", [])):
        have = F.lit(True)
        for term in g:
            have &= F.array_contains(all_, term)
        group = F.when(have, F.array(*map(F.lit, g))).otherwise(group)
    hit = lambda cond, strength, channel, terms: (cond, F.struct(F.lit(strength).alias("strength"), F.lit(channel).alias("channel"), terms.alias("terms")))
    some = lambda c: F.size(c) > 0
    chain = [
        hit(some(among(s, "direct")), "strong", "direct_subject", among(s, "direct")), hit(some(among(t, "strong")), "strong", "title_strong_term", among(t, "strong")),
        hit(some(among(t, "weak")) & ~excluded, "weak", "title_domain_term", among(t, "weak")), hit(some(among(meta, "strong")) & ~excluded, "weak", "metadata_strong_term", among(meta, "strong")),
        hit(some(group) & ~excluded, "weak", "cooccurrence_group", group), hit(some(among(s, "adjacent")) & some(among(all_, "weak")) & ~excluded, "weak", "adjacent_plus_domain", F.array_sort(F.array_union(among(s, "adjacent"), among(all_, "weak")))),
        hit((F.size(among(all_, "weak")) >= 2) & ~excluded, "weak", "multiple_weak_terms", among(all_, "weak")),
    ]
    out = None
    for cond, value in chain:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return d.withColumn("recall", out).drop("_s", "_t", "_o")


def beam_route(records: DataFrame, tree: DataFrame, score: Callable[[DataFrame], DataFrame], *, width: int, threshold: float, max_depth: int | None = None, least_depth: int = 1) -> DataFrame:
    """Level-wise routing of records down a forest, from every root: (record, path, path_score, decision). With
    ``max_depth``, beams still open there end; without, routing goes as deep as the forest.

    ``score`` gets (record, node, child and the record's columns) and adds ``p`` and ``stop`` (evidence for stopping at the
    node). Of each beam the ``width`` best children at or above the threshold go on, of each record the ``width`` best
    beams stay; beams end at leaves, when no child is good enough (truncated), or where a stop is asked for. A beam's score
    is the geometric mean of its levels."""
    kids = tree.select(F.col("parent").alias("node"), F.col("code").alias("child"))
    roots = tree.where("parent is null").agg(F.array_sort(F.collect_list("code")).alias("r")).first().r  # a taxonomy's trees
    beams = records.select("record", F.explode(F.from_json(F.lit(json.dumps(roots)), "array<string>")).alias("node")).select("record", "node", F.array().cast("array<string>").alias("path"), F.lit(0.0).alias("log_score"), F.lit("open").alias("state"))
    inner = tree.where("parent is not null").select(F.col("parent").alias("node")).distinct().withColumn("_inner", F.lit(True))
    best = W.partitionBy("record").orderBy(F.col("log_score").desc(), F.array_join("path", "/"), "node")
    beams, level = written(beams), 0
    while (max_depth is None or level < max_depth) and not beams.where("state = 'open'").isEmpty():
        level += 1
        live = beams.where("state = 'open'")
        scored = written(score(live.join(records, "record").join(kids, "node")))
        halt = scored.groupBy("record", "node", "path").agg(F.bool_or("stop").alias("halt"))
        live = live.join(halt, ["record", "node", "path"], "left")
        good = scored.join(halt, ["record", "node", "path"]).where(~F.col("halt") & (F.col("p") >= threshold))
        good = good.withColumn("_r", F.row_number().over(W.partitionBy("record", "node", "path").orderBy(F.col("p").desc(), "child"))).where(F.col("_r") <= width)
        grown = good.select("record", F.col("child").alias("node"), F.concat("path", F.array("child")).alias("path"), (F.col("log_score") + F.ln("p")).alias("log_score")).join(inner, "node", "left")
        grown = grown.select("record", "node", "path", "log_score", F.when(F.col("_inner"), "open").otherwise("leaf").alias("state"))
        moved = good.select("record", "node", "path").distinct().withColumn("_moved", F.lit(True))
        ended = live.join(moved, ["record", "node", "path"], "left").where("_moved is null").select("record", "node", "path", "log_score", F.when(F.col("halt"), "stopped").otherwise("truncated").alias("state"))
        every = beams.where("state <> 'open'").unionByName(grown).unionByName(ended)
        beams = written(every.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= width).drop("_r"))
    n = F.size("path")
    d = beams.withColumn("path_score", F.when(n > 0, F.exp(F.col("log_score") / n)).otherwise(0.0))
    d = d.withColumn("_r", F.row_number().over(W.partitionBy("record").orderBy(F.col("path_score").desc(), F.array_join("path", "/")))).where("_r = 1")
    decision = F.when(n == 0, "insufficient_evidence").when(F.col("state") == "stopped", F.when(n >= least_depth, "accepted_parent").otherwise("needs_review")).when((F.col("state") == "leaf") & (n >= least_depth), "accepted_leaf").when(F.col("state") == "open", F.when(n >= least_depth, "accepted_parent").otherwise("needs_review")).otherwise("needs_review")
    return d.select("record", "path", F.bround("path_score", 6).alias("path_score"), decision.alias("decision"))


def accepted_candidates(df: DataFrame, tops: str, best: str, least_score: float, most_related: int) -> DataFrame:
    """Adds ``primary`` and ``related``: of the other top paths (array<struct<codes, score, truncated>>) in order those that
    are good enough, whole, new and neither above nor below the primary, at most ``most_related``."""
    p = F.col(best)
    starts = lambda a, b: F.slice(a, 1, F.size(b)) == b
    ok = F.filter(tops, lambda x: (x["score"] >= least_score) & (x["score"] <= 1.0) & ~F.coalesce(x["truncated"], F.lit(False)) & ~starts(x["codes"], p) & ~starts(p, x["codes"]))
    names = F.array_distinct(F.transform(ok, lambda x: F.array_join(x["codes"], "/")))
    return df.withColumn("primary", F.array_join(p, "/")).withColumn("related", F.slice(names, 1, most_related))


#: Fixed values of the confidence calibration.
NEUTRAL_WARNINGS = ["root_type_forced", "subtree_type_forced"]
PATH_CONFLICTS = ["path_conflict", "reason_path_conflict", "component_to_whole", "tool_to_whole", "process_route_path"]


def calibrated(df: DataFrame, *, decision: str, depth: str, path_score: str, levels: str, tops: str, clean: str, warnings: str) -> DataFrame:
    """Adds ``cal``: struct<direction, specificity, norm_score, overall, penalty, tier, flags>.

    levels: array<struct<level, conf>> in order of level; tops: scores of the best paths; clean: what the input's cleaning
    decided; warnings: an array of types."""
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    n = F.col(depth)
    norm = F.when(n > 0, F.pow(clamp(F.col(path_score)), 1.0 / n)).otherwise(clamp(F.col(path_score)))
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    top3 = F.transform(F.filter(levels, lambda x: x["level"].between(1, 3)), lambda x: clamp(x["conf"]))
    deep = F.transform(F.filter(levels, lambda x: x["level"] >= 4), lambda x: clamp(x["conf"]))
    d = df.withColumn("_n", norm).withColumn("_top", top3).withColumn("_deep", deep)
    base = F.when(F.size("_top") > 0, F.col("_top")).otherwise(F.array("_n"))
    direction = clamp(0.6 * F.array_min(base) + 0.4 * mean(base))
    specific = F.when(F.size("_deep") > 0, clamp(0.5 * mean(F.col("_deep")) + 0.5 * F.element_at("_deep", -1))).otherwise(0.55)
    risky = F.filter(warnings, lambda w: ~w.isin(NEUTRAL_WARNINGS) & (w != ""))
    conflict = F.exists(risky, lambda w: F.lower(w).rlike("|".join(PATH_CONFLICTS)))
    gap = F.when(F.size(tops) >= 2, F.get(F.col(tops), F.lit(0)) - F.get(F.col(tops), F.lit(1)))
    parts = [
        (F.col(clean) == "recall_with_risk", 0.06, "input_recall_with_risk"), (F.col(clean).isin("needs_review", "need_review"), 0.14, "input_needs_review"), (conflict, 0.10, "path_conflict_or_boundary_warning"),
        ((F.col(path_score) > 0) & (F.col(path_score) < 0.72), 0.08, "low_raw_path_score"), ((F.col("_n") > 0) & (F.col("_n") < 0.88), 0.06, "low_normalized_path_score"),
        ((F.col(decision) == "accepted_parent") & (n <= 2), 0.08, "shallow_parent_mount"), (gap < 0.03, 0.10, "low_top_path_margin"), ((gap >= 0.03) & (gap < 0.08), 0.05, "medium_top_path_margin"),
    ]
    fine = F.least(F.lit(0.12), 0.04 * F.size(risky))
    for cond, amount, _ in parts:
        fine = fine + F.when(cond, amount).otherwise(0.0)
    penalty = F.least(fine, F.lit(0.60))
    d = d.withColumn("_dir", direction).withColumn("_spec", specific).withColumn("_pen", penalty)
    overall = F.when(F.col(decision) == "accepted_parent", clamp(0.75 * F.col("_dir") + 0.15 * F.col("_n") + 0.10 * F.col("_spec") - F.col("_pen"))).otherwise(clamp(0.55 * F.col("_dir") + 0.35 * F.col("_spec") + 0.10 * F.col("_n") - F.col("_pen")))
    d = d.withColumn("_all", overall)
    calm = F.size(risky) == 0
    tier = F.when((F.col("_all") >= 0.82) & (F.col("_dir") >= F.when(F.col(decision) == "accepted_parent", 0.86).otherwise(0.85)) & calm, "high_confidence").when((F.col("_all") >= 0.70) & (F.col("_dir") >= 0.78), "medium_confidence").otherwise("low_confidence")
    cap = F.when(F.col(clean).isin("needs_review", "need_review") | ((F.col(clean) == "recall_with_risk") & (F.col(decision) == "accepted_parent")), "medium_confidence")
    tier = F.when((cap == "medium_confidence") & (tier == "high_confidence"), "medium_confidence").otherwise(tier)
    accepted = F.col(decision).isin("accepted_leaf", "accepted_parent")
    flags = T.reasons(*[(c, name) for c, _, name in parts])
    zero = F.lit(0.0)
    pick = lambda c: F.when(accepted, F.bround(c, 6)).otherwise(zero)
    cal = F.struct(pick(F.col("_dir")).alias("direction"), pick(F.col("_spec")).alias("specificity"), F.bround("_n", 6).alias("norm_score"), pick(F.col("_all")).alias("overall"), pick(F.col("_pen")).alias("penalty"), F.when(accepted, tier).otherwise("not_accepted").alias("tier"), F.when(accepted, flags).otherwise(F.array(F.concat(F.lit("decision:"), F.col(decision)))).alias("flags"))
    return d.withColumn("cal", cal).drop("_n", "_top", "_deep", "_dir", "_spec", "_pen", "_all")


def constrained(df: DataFrame, candidates: str, rules: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Routing candidates that satisfy all plugged-in rules, and in ``vetoes`` the rules that took one away. A rule that is
    null for a candidate does not take it away; without rules all stay."""
    def broken(rule):
        return lambda x: ~F.coalesce(rule(x), F.lit(True))

    def held(rule):
        return lambda x: F.coalesce(rule(x), F.lit(True))

    names = [F.when(F.exists(candidates, broken(f)), F.lit(n)) for n, f in rules.items()]
    out = df.withColumn("vetoes", F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))
    for f in rules.values():
        out = out.withColumn(candidates, F.filter(candidates, held(f)))
    return out
