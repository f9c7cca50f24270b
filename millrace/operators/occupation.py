"""Occupation classes: profiles from known offers, scores, assignment, measures and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scores import band
from millrace.sources.tables import table


@dataclass(frozen=True)
class Config:
    name: str
    title: float
    skill: float
    description: float
    score: float
    margin: float
    ratio: float
    bonus: float
    discriminant: bool


# Fixed values.
BASELINE = Config("BASELINE", 55, 30, 15, 20, 8, 1.1, 0, False)
V1_A = Config("V1_A", 65, 10, 25, 60, 5, 0.35, 8, True)
V1_B = Config("V1_B", 70, 10, 20, 60, 5, 0.30, 10, True)
TOP_TITLES, TOP_SKILLS, TOP_DESCRIPTION = 80, 80, 160


def top_values(rows: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """The k most frequent values of each group, ties by value."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), value))).filter(F.col("rank") <= k).select(group, value)


def profile_values(known: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((code, token, field), (code, title)): what the profiles of known offers are made of, whatever share of them may have a token."""
    seen = known.select("code").distinct()
    base = labels.join(seen, "code").select("code", F.explode("tokens").alias("token"))
    known = known.withColumn("title", F.nullif("title", F.lit("")))
    observed = top_values(known.filter("title IS NOT NULL"), "code", "title", TOP_TITLES)
    titles = observed.join(known.select("title", "title_tokens").distinct(), "title").select("code", F.explode("title_tokens").alias("token"))
    skills = top_values(known.select("code", F.explode("skill_tokens").alias("token")), "code", "token", TOP_SKILLS)
    words = top_values(known.select("code", F.explode("description_tokens").alias("token")), "code", "token", TOP_DESCRIPTION)
    t = base.unionByName(titles).distinct().withColumn("field", F.lit("title"))
    s = base.unionByName(titles).unionByName(skills).distinct().withColumn("field", F.lit("skill"))
    d = base.unionByName(titles).unionByName(words).distinct().withColumn("field", F.lit("description"))
    exact = labels.join(seen, "code").select("code", F.explode("exact").alias("x")).unionByName(observed.select("code", F.col("title").alias("x")))
    return t.unionByName(s).unionByName(d), exact


def profiles(known: DataFrame, labels: DataFrame, ratio: float = 1.1, values: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """code, title_tokens, skill_tokens, description_tokens, exact_titles for each code seen among known offers.

    known(id, code, title, title_tokens, skill_tokens, description_tokens), tokens distinct in a row (skill tokens: in a skill);
    labels(code, tokens, exact). A code whose tokens are all left out keeps its exact titles. A token in more than max(2, ratio * profiles) profiles is left out of its field where ratio <= 1.
    values: profile_values(known, labels), where they are written already."""
    seen = known.select("code").distinct()
    every, exact = values or profile_values(known, labels)
    if ratio <= 1:
        n = F.broadcast(seen.agg(F.count("*").alias("p")))  # one row
        often = every.groupBy("field", "token").agg(F.count("*").alias("n")).crossJoin(n).filter(F.col("n") > F.greatest(F.lit(2), F.floor(F.col("p") * ratio))).select("field", "token")
        every = every.join(often, ["field", "token"], "left_anti")
    lists = every.groupBy("code").agg(*[F.array_sort(F.collect_set(F.when(F.col("field") == f, F.col("token")))).alias(f"{f}_tokens") for f in ("title", "skill", "description")])
    lists = seen.join(lists, "code", "left").select("code", *[F.coalesce(f"{f}_tokens", F.array().cast("array<string>")).alias(f"{f}_tokens") for f in ("title", "skill", "description")])
    return lists.join(exact.groupBy("code").agg(F.array_sort(F.collect_set("x")).alias("exact_titles")), "code", "left")


def class_scores(offers: DataFrame, profile: DataFrame, c: Config = V1_A) -> DataFrame:
    """Every offer with every profile that it shares a token or its title with: id, code, score and its parts.

    Pairs come from an equi-join on tokens; profiles without a hit score 0 and are never better than one with a hit."""
    fields = ("title", "skill", "description")
    # distinct while they are strings: those are hashed, structs would be compared each with each
    tagged = lambda f: F.transform(F.array_distinct(f"{f}_tokens"), lambda t: F.struct(F.lit(f).alias("f"), t.alias("t")))
    keys = F.explode(F.concat(*map(tagged, fields))).alias("k")
    q, p = offers.select("id", keys), profile.select("code", keys)
    hits = q.join(p, "k").groupBy("id", "code").agg(*[F.sum((F.col("k.f") == f).cast("int")).alias(f) for f in fields])
    exact = offers.select("id", "title").join(profile.select("code", F.explode("exact_titles").alias("title")), "title").select("id", "code", F.lit(1).alias("exact"))
    sizes = offers.select("id", *[F.size(f"{f}_tokens").alias(f"n_{f}") for f in fields])
    j = hits.join(exact, ["id", "code"], "full_outer").join(sizes, "id")
    part = lambda f: F.when(F.col(f"n_{f}") > 0, F.round(100.0 * F.coalesce(f, F.lit(0)) / F.col(f"n_{f}"), 4)).otherwise(0.0)
    parts = {f: part(f) for f in fields}
    score = F.round((parts["title"] * c.title + parts["skill"] * c.skill + parts["description"] * c.description) / 100 + F.coalesce("exact", F.lit(0)) * c.bonus, 4)
    return j.select("id", "code", score.alias("score"), *[parts[f].alias(f"{f}_score") for f in fields], F.coalesce("exact", F.lit(0)).alias("exact"))


def top_classes(scores: DataFrame, k: int = 3) -> DataFrame:
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "code"))).filter(F.col("rank") <= k)


def best_class(scores: DataFrame) -> DataFrame:
    """id, code, score, second, margin, discriminant of the best class; a missing second scores 0."""
    t = top_classes(scores, 2)
    one = t.groupBy("id").agg(F.max(F.when(F.col("rank") == 1, F.struct("code", "score", "title_score", "skill_score"))).alias("x"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("s"))
    second = F.coalesce("s", F.lit(0.0))
    return one.select("id", F.col("x.code").alias("code"), F.col("x.score").alias("score"), second.alias("second"), (F.col("x.score") - second).alias("margin"), ((F.col("x.title_score") > 0) | (F.col("x.skill_score") > 0)).alias("discriminant"))


def assignment(c: Config = V1_A) -> Column:
    """struct(status, reason) over matched_code, generic_title, score, margin, discriminant."""
    rungs = [
        (F.col("matched_code").isNotNull(), "CONFIRMED_FROM_MATCH", "MATCH"),
        (F.col("generic_title"), "INSUFFICIENT", "GENERIC_TITLE"),
        (F.coalesce("score", F.lit(0.0)) < c.score, "INSUFFICIENT", "NO_SUFFICIENT_SIGNAL"),
        (F.lit(c.discriminant) & ~F.coalesce("discriminant", F.lit(False)), "INSUFFICIENT", "NO_DISCRIMINANT_SIGNAL"),
        (F.col("margin") < c.margin, "AMBIGUOUS", "CLOSE_CANDIDATES"),
    ]
    out = None
    for cond, status, reason in rungs:
        s = F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))
        out = F.when(cond, s) if out is None else out.when(cond, s)
    return out.otherwise(F.struct(F.lit("AUTO_ASSIGNED").alias("status"), F.lit("CLEAR_WINNER").alias("reason")))


def accuracy(predictions: DataFrame) -> DataFrame:
    """One row over (id, truth, codes, rank 1 first): rows, top-1, top-3, unassigned."""
    n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    return predictions.agg(F.count("*").alias("n"), n(F.try_element_at("codes", F.lit(1)) == F.col("truth")).alias("top1"), n(F.array_contains(F.slice("codes", 1, 3), F.col("truth"))).alias("top3"), n(F.size("codes") <= 0).alias("unassigned"))


def class_accuracy(predictions: DataFrame) -> DataFrame:
    """(truth, n, top1, top3, accuracy, recall) of each class over (id, truth, codes, rank 1 first)."""
    n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    by = predictions.groupBy("truth").agg(F.count("*").alias("n"), n(F.try_element_at("codes", F.lit(1)) == F.col("truth")).alias("top1"), n(F.array_contains(F.slice("codes", 1, 3), F.col("truth"))).alias("top3"))
    return by.withColumn("accuracy", F.round(F.col("top1") / F.col("n"), 4)).withColumn("recall", F.round(F.col("top3") / F.col("n"), 4))


def majority_baseline(predictions: DataFrame) -> DataFrame:
    """One row, code, n, share: the class that is right most often for whoever always names it; of equal ones the first by code."""
    by = predictions.groupBy("truth").agg(F.count("*").alias("n"))
    return by.orderBy(F.desc("n"), "truth").limit(1).crossJoin(by.agg(F.sum("n").alias("all"))).select(F.col("truth").alias("code"), "n", F.round(F.col("n") / F.col("all"), 4).alias("share"))  # one row each


def outcome_bands(best: DataFrame, width: int = 20) -> DataFrame:
    """(measure, correct, band, n): scores and margins of right and of wrong predictions by bands of `width`."""
    right = F.coalesce(F.col("code") == F.col("truth"), F.lit(False))
    entries = F.array(*[F.struct(F.lit(c).alias("measure"), band(F.coalesce(c, F.lit(0.0)), width).alias("band")) for c in ("score", "margin")])
    return best.select(right.alias("correct"), F.explode(entries).alias("e")).groupBy("e.measure", "correct", "e.band").agg(F.count("*").alias("n"))


def confusion(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("truth", F.col("code").alias("predicted")).agg(F.count("*").alias("n"))


def threshold_grid(best: DataFrame, scores: tuple[int, ...] = tuple(range(50, 81, 5)), margins: tuple[int, ...] = tuple(range(5, 31, 5))) -> DataFrame:
    """(min_score, min_margin, covered, correct, precision) for every pair of thresholds.

    A row counts once, in the cell of the greatest thresholds that it meets; sums over the cells of higher scores and then of
    higher margins give all thresholds. Rows without a score or margin, or below the least thresholds, are in no cell."""
    reached = lambda c, limits: F.array_max(F.filter(F.array(*map(F.lit, limits)), lambda x: F.col(c) >= x))
    cells = best.select(reached("score", scores).alias("min_score"), reached("margin", margins).alias("min_margin"), F.coalesce((F.col("code") == F.col("truth")).cast("long"), F.lit(0)).alias("ok"))
    cells = cells.filter("min_score IS NOT NULL AND min_margin IS NOT NULL").groupBy("min_score", "min_margin").agg(F.count("*").alias("n"), F.sum("ok").alias("ok"))
    grid = best.sparkSession.createDataFrame([(s, m, 0, 0) for s in scores for m in margins], "min_score int, min_margin int, n long, ok long")
    cells = cells.unionByName(grid).groupBy("min_score", "min_margin").agg(F.sum("n").alias("n"), F.sum("ok").alias("ok"))  # a row for each cell
    upwards = lambda by, order: Window.partitionBy(by).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    for by, order in (("min_margin", "min_score"), ("min_score", "min_margin")):
        cells = cells.withColumns({c: F.sum(c).over(upwards(by, order)) for c in ("n", "ok")})
    out = cells.select("min_score", "min_margin", F.col("n").alias("covered"), F.col("ok").alias("correct"))
    return out.withColumn("precision", F.when(F.col("covered") > 0, F.col("correct") / F.col("covered")))


def select_threshold(grid: DataFrame, least: int = 5, precision: float = 0.9) -> DataFrame:
    """The grid's best row: precise enough if any is, else covered enough, else 100/100."""
    g = grid.filter(F.col("covered") >= least).withColumn("tier", F.when(F.col("precision") >= precision, 0).otherwise(1)).orderBy("tier", F.desc("precision"), F.desc("covered"), "min_score", "min_margin").limit(1)
    none = grid.sparkSession.createDataFrame([(100, 100, 2)], "min_score int, min_margin int, tier int")
    return g.select("min_score", "min_margin", "tier").unionByName(none).orderBy("tier").limit(1).select("min_score", "min_margin")


def split(references: DataFrame, seed: str, share: float = 0.7) -> DataFrame:
    """(id, code, part): each class's ids in the order of a hash, the first part for calibration.

    Classes of four ids or more are split by rank. Ids of smaller classes go to calibration while it has at most twice the ids of
    validation, over classes in the order of their codes. That running balance is folded over one row for each class, in one task;
    ids themselves stay where they are."""
    n = references.withColumn("h", F.sha2(F.concat_ws(":", F.lit(seed), "code", F.col("id").cast("string")), 256))
    w = Window.partitionBy("code")
    n = n.withColumn("n", F.count("*").over(w)).withColumn("rank", F.row_number().over(w.orderBy("h", "id")))
    first = F.greatest(F.lit(1), F.bround(F.col("n") * share)).cast("long")
    classes = references.groupBy("code").agg(F.count("*").alias("n"))
    classes = classes.select("code", "n", F.when(F.col("n") >= 4, 3 * first - 2 * F.col("n")).alias("step"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        """Each class's parts, by the balance (calibration - 2 * validation) before each of its ids; large classes have none."""
        balance, out = 0, []
        for code, n, step in pdf.sort_values("code")[["code", "n", "step"]].itertuples(index=False):
            parts = []
            if pd.notna(step):
                balance += int(step)
            else:
                for _ in range(n):
                    parts.append("calibration" if balance <= 0 else "validation")
                    balance += 1 if balance <= 0 else -2
            out.append((code, parts))
        return pd.DataFrame(out, columns=["code", "parts"])

    code_type = references.schema["code"].dataType.simpleString()
    parts = classes.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(fold, f"code {code_type}, parts array<string>")
    dealt = n.join(parts, "code").withColumn("part", F.when(F.col("n") >= 4, F.when(F.col("rank") <= first, "calibration").otherwise("validation")).otherwise(F.try_element_at("parts", F.col("rank"))))
    return dealt.select("id", "code", "part")


def references(decisions: DataFrame) -> DataFrame:
    """(id, code, known_id): offers decided to be present, with the code and id of the offer that they were matched to."""
    return decisions.filter("decision = 'PRESENT' AND best_code IS NOT NULL").select("id", F.col("best_code").alias("code"), F.col("best_id").alias("known_id"))


def held_out(known: DataFrame, refs: DataFrame) -> DataFrame:
    """Known offers that no reference was matched to: what profiles may learn from when references measure them."""
    return known.join(refs.filter("known_id IS NOT NULL").select(F.col("known_id").alias("id")).distinct(), "id", "left_anti")


def reference_predictions(offers: DataFrame, known: DataFrame, labels: DataFrame, refs: DataFrame, c: Config, values: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(id, truth, code, score, margin, codes) of every reference that is an offer, by profiles of the known offers given (values: as
    for profiles)."""
    refs = refs.select("id", F.col("code").alias("truth"))
    asked = offers.join(refs.select("id"), "id", "left_semi")
    scores = table(class_scores(asked, profiles(known, labels, c.ratio, values), c))
    top = top_classes(scores).groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "code"))), lambda x: x["code"]).alias("codes"))
    best = best_class(scores).select("id", "code", "score", "margin")
    j = asked.select("id").join(refs, "id").join(best, "id", "left").join(top, "id", "left")
    return j.select("id", "truth", "code", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("margin", F.lit(0.0)).alias("margin"), F.coalesce("codes", F.array().cast("array<string>")).alias("codes"))


def assignment_metrics(predictions: DataFrame, score: float, margin: float) -> DataFrame:
    """One row: rows, those assigned at the thresholds, their precision and share, and errors."""
    in_ = (F.col("score") >= score) & (F.col("margin") >= margin)
    n = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0))
    one = predictions.agg(F.count("*").alias("sample_size"), n(in_).alias("auto_assigned"), n(in_ & ~F.col("code").eqNullSafe(F.col("truth"))).alias("errors"))
    share = lambda a, b: F.when(F.col(b) > 0, F.round(a / F.col(b), 4))
    return one.select("sample_size", "auto_assigned", "errors", share(F.col("auto_assigned") - F.col("errors"), "auto_assigned").alias("precision"), F.coalesce(share(F.col("auto_assigned"), "sample_size"), F.lit(0.0)).alias("coverage"))


def benchmark(offers: DataFrame, known: DataFrame, labels: DataFrame, refs: DataFrame, seed: str, configs: tuple[Config, ...] = (BASELINE, V1_A, V1_B), chosen: Config = V1_A) -> tuple[DataFrame, DataFrame]:
    """(config, n, top1, top3, unassigned) of each configuration, and (part, thresholds, metrics) of the chosen one.

    Profiles never see the offers that references were matched to. Thresholds are chosen on the calibration part."""
    learn = table(held_out(known, refs))
    values = tuple(map(table, profile_values(learn, labels)))  # the same for each configuration
    predictions = {c.name: table(reference_predictions(offers, learn, labels, refs, c, values)) for c in configs}
    summary = None
    for name, p in predictions.items():
        one = accuracy(p).select(F.lit(name).alias("config"), "*")
        summary = one if summary is None else summary.unionByName(one)
    mine = table(predictions[chosen.name].join(split(predictions[chosen.name].select("id", F.col("truth").alias("code")), seed).select("id", "part"), "id"))
    best = select_threshold(threshold_grid(mine.filter("part = 'calibration'"))).first()  # one row
    parts = None
    for part, rows in (("calibration", mine.filter("part = 'calibration'")), ("validation", mine.filter("part = 'validation'")), ("all", mine)):
        one = assignment_metrics(rows, best["min_score"], best["min_margin"]).select(F.lit(part).alias("part"), F.lit(best["min_score"]).alias("min_score"), F.lit(best["min_margin"]).alias("min_margin"), "*")
        parts = one if parts is None else parts.unionByName(one)
    return summary, parts


def assignment_queue(assigned: DataFrame) -> DataFrame:
    """Assignments to review, by status, then the best score first, then id."""
    return assigned.orderBy("status", F.desc(F.coalesce("score", F.lit(0.0))), "id")
