"""Blind trials, probe scores, compositions, claims and material for probes."""

from __future__ import annotations

import difflib
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions.text import collapse_space, dedupe_key, jaccard, letter_tokens, question_shape, trim_u, wilson
from threadloom.session import collect_bounded

ENTITY_FLOOR, ANSWERABLE_FLOOR, PER_SHAPE = 5, 5, 3
MIN_CHARS, MAX_CHARS, PER_CATEGORY = 80, 600, 40

# Kinds of checkable claims (case-insensitive).
CATEGORIES = {
    "preferences": r"\b(i (prefer|like|love|hate|avoid|always|never|usually|tend to)|my (approach|rule|preference)|i'?d rather)\b",
    "opinions": r"\b(i think|i believe|in my (view|experience)|the (problem|issue) with)\b",
    "decisions": r"\b(we (decided|went with|chose|settled on)|i (decided|went with|chose|switched to)|going with)\b",
    "history": r"\b(back (when|then)|used to|years ago|when i (worked|was at)|before (that|i))\b",
}

# Five families of sensitive terms (case-insensitive).
SENSITIVE = "|".join((
    r"\b(oxy|opioid|suboxone|methadone|benzo|xanax|taper(ing|ed|s)?|withdrawal|relaps\w*|dose|dosage|\d+\s*mg)\b",
    r"\b(suicid\w*|kill\s+myself|end(ing)?\s+(my\s+life|it)|early\s+exit|self.harm|overdose|hopeless)\b",
    r"\bcan'?t\s+(go\s+on|live\s+like\s+this|keep\s+going)\b",
    r"\b(diagnos\w*|prescri\w*|therapist|psychiatrist|medication|meds)\b",
    r"\b(divorce|marriage\s+counsel\w*|custody|affair|invalidated)\b",
    r"\bi\s+love\s+you\b",
    r"\b(lawyer|attorney|legal\s+counsel|law\s+firm|retained\s+counsel|lawsuit|litigation|arbitration|deposition|settlement|severance|wrongful\s+termination|retaliation|nda)\b",
    r"\b(eprs?|va\s+(claim|disability)|disability\s+claim)\b",
))

# Attributes by kind of entity: key, what its presence looks like, question.
ATTRIBUTES = {
    "product": [
        ("user_count", r"\b\d[\d,]*\s*(paying\s*)?(users?|subscribers?|customers?|downloads?)\b", "How many users does {e} have?"),
        ("price", r"(\$\s?\d|\b\d+\s*(dollars|bucks)\b|\bper\s+month\b|/mo\b|\bpricing\b)", "What does {e} cost to use?"),
        ("launch_date", r"\b(launched|released|shipped|went live|first version)\b", "What date did {e} launch?"),
        ("revenue", r"\b(revenue|mrr|arr|profit|earns?)\b", "How much revenue does {e} make?"),
    ],
    "org": [
        ("team_size", r"\b\d[\d,]*\s*(people|engineers|devs)\s*(on|in)\s*(my|the)\s*team\b", "How many people were on my team at {e}?"),
        ("tenure", r"\b(\d+\s*(years?|months?)\s*(at|with)|joined in|started (there|at))\b", "How long did I work at {e}?"),
        ("manager", r"\b(my manager|reported to|my boss|skip.level)\b", "Who was my manager at {e}?"),
    ],
    "tech": [
        ("version", r"\bv?\d+\.\d+(\.\d+)?\b", "What version of {e} was I using?"),
        ("adoption_date", r"\b(started using|switched to|adopted|picked up)\b", "When did I start using {e}?"),
    ],
    "service": [("adoption_date", r"\b(started using|switched to|adopted|picked up)\b", "When did I start using {e}?")],
    "feature": [
        ("build_duration", r"\b(took (me )?\d+|\d+\s*(days?|weeks?|months?)\s*(to|of))\b", "How long did {e} take to build?"),
        ("collaborator", r"\b(worked with|paired with|helped me|we built)\b", "Who worked on {e} with me?"),
    ],
}


# What counts as a topic, and the phrases that are none.
TOPIC = r"\b([A-Z][A-Za-z0-9.+#-]{2,}(?: [A-Z][A-Za-z0-9.+#-]{2,}){0,2})\b"
TOPIC_STOP = ("i", "the", "this", "that", "and")


def build_trials(pairs: DataFrame, candidates: DataFrame, seed: int = 0) -> DataFrame:
    """One blind trial per thread: a reply, its generated rival, and which side the real one is on.

    ``pairs`` has thread_id, source, source_id, context, text; ``candidates`` has
    source, source_id, candidate.  The pair of a thread and the side follow a seeded
    hash, so neither row order nor partitioning matters.  Pairs without candidate
    give no trial.
    """
    j = pairs.join(candidates, ["source", "source_id"])
    h = F.sha2(F.concat_ws(":", F.lit(seed), "thread_id", "source", "source_id"), 256)
    pick = j.withColumn("h", h).groupBy("thread_id").agg(F.min(F.struct("h", "source", "source_id", "context", "text", "candidate")).alias("p"))
    real_is_a = F.conv(F.substring("p.h", 64, 1), 16, 10).cast("int") % 2 == 0
    return pick.select(
        F.sha2(F.concat_ws(":", "p.source", "p.source_id"), 256).substr(1, 16).alias("trial_id"), "thread_id", F.col("p.context").alias("context"),
        F.when(real_is_a, F.col("p.text")).otherwise(F.col("p.candidate")).alias("option_a"), F.when(real_is_a, F.col("p.candidate")).otherwise(F.col("p.text")).alias("option_b"), real_is_a.alias("real_is_a"),
    )


def score_trials(trials: DataFrame, guesses: DataFrame) -> DataFrame:
    """n, correct, accuracy (null for no trials) and its Wilson interval; a missing or odd guess is wrong, a repeated trial an error."""
    unique = trials.groupBy("trial_id").agg(F.first("real_is_a").alias("real_is_a"), F.count("*").alias("k"))
    ok = F.when(F.col("k") > 1, F.raise_error(F.concat(F.lit("repeated trial "), F.col("trial_id"))).cast("boolean")).otherwise(F.col("real_is_a"))
    g = guesses.groupBy("trial_id").agg(F.min(F.lower(F.trim("guess"))).alias("guess"))
    j = unique.withColumn("real_is_a", ok).join(g, "trial_id", "left")
    right = F.coalesce(F.col("guess") == F.when(F.col("real_is_a"), "a").otherwise("b"), F.lit(False))
    a = j.agg(F.count("*").alias("n"), F.count_if(right & F.col("real_is_a").isNotNull()).alias("correct"))
    lo, hi = wilson(F.col("correct"), F.col("n"))
    return a.select("n", "correct", (F.col("correct") / F.nullif(F.col("n"), F.lit(0))).alias("accuracy"), lo.alias("ci_low"), hi.alias("ci_high"))


def score_facts(probes: DataFrame, answers: DataFrame) -> DataFrame:
    """n, correct, fabrications, accuracy over probes; an answer must be there for each (empty is an abstention), else an error.

    Answerable: equal without case and outer blanks.  Not answerable: correct if
    the answer is blank, else a fabrication.
    """
    j = probes.join(answers.withColumn("_has", F.lit(True)), "probe_id", "left")
    ans = F.when(F.col("_has").isNull(), F.raise_error(F.concat(F.lit("no answer for "), F.col("probe_id"))).cast("string")).otherwise(F.lower(trim_u(F.coalesce("answer", F.lit("")))))
    j = j.withColumn("_a", ans)
    right = F.when(F.col("answerable"), F.col("_a") == F.lower(trim_u(F.coalesce("expected", F.lit(""))))).otherwise(F.col("_a") == "")
    a = j.agg(F.count("*").alias("n"), F.count_if(right).alias("correct"), F.count_if(~F.col("answerable") & (F.col("_a") != "")).alias("fabrications"))
    return a.withColumn("accuracy", F.coalesce(F.col("correct") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)))


def score_refusals(probes: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Agreed, n and rate of declining where one should and answering where one should; every probe needs an outcome."""
    j = probes.join(outcomes, "probe_id", "left")
    d = F.when(F.col("declined").isNull(), F.raise_error(F.concat(F.lit("no outcome for "), F.col("probe_id"))).cast("boolean")).otherwise(F.col("declined"))
    a = j.agg(F.count_if(d == F.col("should_decline")).alias("agreed"), F.count("*").alias("n"))
    return a.withColumn("rate", F.coalesce(F.col("agreed") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)))


def fact_composition(probes: DataFrame) -> DataFrame:
    """n, answerable, unanswerable, share of the latter, and the share and text of the commonest question shape."""
    p = probes.withColumn("shape", question_shape(F.coalesce("question", F.lit(""))))
    tops = p.groupBy("shape").agg(F.count("*").alias("k")).agg(F.max(F.struct(F.col("k").alias("k"), F.col("shape").alias("shape"))).alias("t"))
    a = p.agg(F.count("*").alias("n"), F.count_if("answerable").alias("answerable"), F.count_if(~F.col("answerable")).alias("unanswerable"))
    a = a.join(F.broadcast(tops))  # one row
    part = lambda c: F.coalesce(c / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0))
    return a.select("n", "answerable", "unanswerable", part(F.col("unanswerable")).alias("share"), part(F.col("t.k")).alias("top_shape_share"), F.col("t.shape").alias("top_shape"))


def fact_gate(probes: DataFrame, least: int = 200, low: float = 0.4, high: float = 0.6, shape: float = 0.15) -> DataFrame:
    """The composition's verdict: passed and the first rule it breaks."""
    why = (
        F.when(F.col("n") < least, "too few probes")
        .when(~F.col("share").between(low, high), "share of unanswerable probes out of range")
        .when(F.col("top_shape_share") > shape, "one question shape too common")
        .otherwise("")
    )
    return fact_composition(probes).withColumn("note", why).withColumn("passed", F.col("note") == "")


def refusal_gate(probes: DataFrame, least: int = 60, low: float = 0.4, high: float = 0.6) -> DataFrame:
    a = probes.agg(F.count("*").alias("n"), F.count_if("should_decline").alias("declining"))
    a = a.withColumn("share", F.coalesce(F.col("declining") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)))
    why = F.when(F.col("n") < least, "too few probes").when(~F.col("share").between(low, high), "share of declining probes out of range").otherwise("")
    return a.withColumn("note", why).withColumn("passed", F.col("note") == "")


def _any_case(p: str) -> str:
    return "(?iuU)" + p


def _escaped(s: str) -> str:
    return "".join("\\" + c if c in r"\.^$|?*+(){}[]-" else c for c in s)


def entity_counts(turns: DataFrame, entities: Mapping[str, str], text: str = "text") -> DataFrame:
    """Per entity and attribute of its kind: turns with the entity, and those of them with the attribute.

    All counts come from one pass over the turns: an array of hits per turn is
    exploded, never a join of turns with entities.
    """
    flags = []
    for pos, (e, kind) in enumerate(entities.items()):
        hit = F.col(text).rlike(_any_case(_escaped(e)))
        for i, (attr, pattern, question) in enumerate(ATTRIBUTES.get(kind, [])):
            flags.append(F.struct(
                F.lit(pos).alias("pos"), F.lit(e).alias("entity"), F.lit(kind).alias("kind"), F.lit(i).alias("attr_pos"), F.lit(attr).alias("attribute"), F.lit(question.replace("{e}", e)).alias("question"),
                F.coalesce(hit, F.lit(False)).alias("hit"), F.coalesce(hit & F.col(text).rlike(_any_case(pattern)), F.lit(False)).alias("both"),
            ))
    x = turns.select(F.explode(F.array(*flags)).alias("f")).select("f.*")
    return x.groupBy("pos", "entity", "kind", "attr_pos", "attribute", "question").agg(F.count_if("hit").alias("entity_hits"), F.count_if("both").alias("attribute_hits"))


def absence_candidates(turns: DataFrame, entities: Mapping[str, str], floor: int = ENTITY_FLOOR, most: int = 0, per_shape: int = PER_SHAPE, text: str = "text") -> DataFrame:
    """Questions nothing in the turns answers: well known entities without a mention of the attribute.

    Column ``skipped`` says why a row is not kept (too few hits, over the cap of its
    question shape, attribute found); null for the candidates.
    """
    c = entity_counts(turns, entities, text)
    free = (F.col("entity_hits") >= floor) & (F.col("attribute_hits") <= most)
    w = Window.partitionBy("attribute", free).orderBy(F.desc("entity_hits"), "pos")  # a row per entity and attribute: small and fixed
    c = c.withColumn("rank", F.row_number().over(w))
    why = F.when(F.col("entity_hits") < floor, "too few hits").when(F.col("attribute_hits") > most, "attribute found").when(F.col("rank") > per_shape, "over the cap of its shape")
    return c.withColumn("skipped", why).drop("pos", "attr_pos", "rank")


def answerable_rows(turns: DataFrame, entities: Mapping[str, str], floor: int = ENTITY_FLOOR, least: int = ANSWERABLE_FLOOR, text: str = "text") -> DataFrame:
    c = entity_counts(turns, entities, text).where((F.col("entity_hits") >= floor) & (F.col("attribute_hits") >= least))
    return c.select("entity", "attribute", "question", "entity_hits", "attribute_hits")


def worksheet_lines(train: DataFrame, heldout: DataFrame, limit: int = PER_CATEGORY, categories: Mapping[str, str] = CATEGORIES, sensitive: str = SENSITIVE) -> DataFrame:
    """Per category the longest distinct lines of checkable claims that no held-out text equals.

    ``(category, rank, line, withheld)``: texts of 80 to 600 characters, sensitive
    ones left out and counted, near-equal ones once (the longest), at most ``limit``
    of a category (it is a top-k list).
    """
    t = train.select(collapse_space(F.col("text")).alias("line"), "source_id").where(F.length("line").between(MIN_CHARS, MAX_CHARS))
    hit = F.array_compact(F.array(*[F.when(F.col("line").rlike(_any_case(p)), F.lit(c)) for c, p in categories.items()]))
    t = t.withColumn("category", F.explode(hit))
    h = heldout.select(collapse_space(F.col("text")).alias("line")).distinct()
    t = t.join(h, "line", "left_anti").withColumn("bad", F.col("line").rlike(_any_case(sensitive))).withColumn("key", dedupe_key(F.col("line")))
    n = t.groupBy("category").agg(F.count_if("bad").alias("withheld"))
    best = t.where("not bad").groupBy("category", "key").agg(F.min(F.struct((-F.length("line")).alias("l"), "line")).alias("b"))
    w = Window.partitionBy("category").orderBy("b.l", "b.line")
    top = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
    return top.join(F.broadcast(n), "category").select("category", "rank", F.col("b.line").alias("line"), "withheld")


def topics(turns: DataFrame, limit: int = 40, least: int = 5) -> DataFrame:
    """Recurring capitalised phrases of one to three words, the most frequent first (ties by the phrase)."""
    rx = f"(?U){TOPIC}"
    t = turns.select(F.explode(F.regexp_extract_all("text", F.lit(rx), 1)).alias("phrase"))
    t = t.where(~F.lower("phrase").isin(*TOPIC_STOP)).groupBy("phrase").agg(F.count("*").alias("n"))
    return t.orderBy(F.desc("n"), "phrase").limit(limit * 3).where(F.col("n") >= least).orderBy(F.desc("n"), "phrase").limit(limit)


def near_duplicate_questions(probes: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs (a, b), a < b, of questions whose letter words overlap by the threshold, joined on a shared prefix word.

    Prefix filter: with words in one order, two sets that overlap by the threshold
    share one of their first n - ceil(t n) + 1 words.
    """
    p = probes.select("item_id", F.array_sort(letter_tokens(F.col("question"))).alias("w")).where(F.size("w") > 0)
    keep = F.size("w") - F.ceil(F.size("w") * F.lit(threshold) - 1e-9) + 1
    x = p.select("item_id", F.explode(F.slice("w", F.lit(1), keep.cast("int"))).alias("word"))
    pairs = x.alias("l").join(x.alias("r"), "word").where("l.item_id < r.item_id").select(F.col("l.item_id").alias("a"), F.col("r.item_id").alias("b")).distinct()
    j = pairs.join(p.select(F.col("item_id").alias("a"), F.col("w").alias("wa")), "a").join(p.select(F.col("item_id").alias("b"), F.col("w").alias("wb")), "b")
    return j.select("a", "b", jaccard(F.col("wa"), F.col("wb")).alias("jaccard")).where(F.col("jaccard") >= threshold)


def _greedy(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[set] = []
        flags = []
        for ws in pdf.sort_values("item_id", kind="stable")["w"]:
            s = set(ws)
            dup = bool(s) and any(e and len(s & e) / len(s | e) >= threshold for e in kept)
            flags.append(not dup)
            if not dup:
                kept.append(s)
        out = pdf.sort_values("item_id", kind="stable")[["item_id"]].copy()
        out["kept"] = flags
        return out

    return run


def intake(probes: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``(item_id, kept)``: in id order each question unless a kept one before it is a near-duplicate.

    The rule is sequential; it runs over a hand-written probe file, which is bounded.
    """
    p = probes.select("item_id", letter_tokens(F.coalesce("question", F.lit(""))).alias("w"))
    return p.withColumn("file", F.lit(0)).groupBy("file").applyInPandas(_greedy(threshold), "item_id bigint, kept boolean")


def similarity(a: Column, b: Column) -> Column:
    """Ratio of matching characters of two texts without case, by longest matching blocks."""

    @F.pandas_udf(T.DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else difflib.SequenceMatcher(None, p.lower(), q.lower()).ratio() for p, q in zip(x, y)])

    return run(a, b)


def claim_recurrence(first: DataFrame, second: DataFrame, least: float = 0.6) -> DataFrame:
    """Claims of one run with the best ratio to any of another run, and whether they recur.

    The second run is a short list read from one report (more than 100,000 claims
    are an error); lengths bound the ratio, so pairs whose lengths alone rule it out
    are never compared.
    """
    rows = [(r[0],) for r in collect_bounded(second.select("text").distinct(), 100_000)]
    b = first.sparkSession.createDataFrame(rows, "other string")
    la, lb = F.length("text"), F.length("other")
    j = first.join(F.broadcast(b), 2.0 * F.least(la, lb) >= F.lit(least) * (la + lb), "left")
    j = j.withColumn("ratio", F.coalesce(similarity(F.coalesce("text", F.lit("")), F.coalesce("other", F.lit(""))), F.lit(0.0)))
    return j.groupBy("claim_id", "text").agg(F.max(F.when(F.col("other").isNull(), 0.0).otherwise(F.col("ratio"))).alias("best")).withColumn("recurs", F.col("best") >= least)
