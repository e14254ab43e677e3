"""URL verdicts: fixed rules first, else naive Bayes over segmented hosts and path words.

Runs of letters in host labels and paths are split into words by a unigram Viterbi: the split with the largest product of
word probabilities, where a stretch of letters that is no known word costs more with every letter.  The probabilities come
from all words that the table's own hosts and paths write apart (by hyphens and signs) and from the fixed word lists.  They
stay a table: a run is met with the words it contains, by a join on its stretches, and split from these alone.

The multinomial naive Bayes learns from what is decided already: a URL that a rule decides is an example of its verdict; of the
others those with a word of the block list are examples of one class and the rest of the other, so words that keep company
with blocked ones gain weight.  Every occurrence of a word counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.llm.html_paths import host_of
from stallweave.llm.tables import drop_path, materialise, sliced, stored

# The rules (host and path, verdict).
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Words of unwanted hosts, and ordinary words of names, both known to the segmenter.
BLOCK_WORDS = (
    "adult bet betting bingo bonus cams casino cheap cialis click clickbait coupon crack dating escort farm gambling hack jackpot keygen loan loans lottery nude payday pharma pharmacy pill pills "
    "poker porn replica sex slots spam spy torrent viagra warez xxx"
).split()
PLAIN_WORDS = (
    "about all art auto baby bank best blog book books buy cafe car care city club cloud code college data day design dev digital docs easy edu fashion film fit food forum free fun game games garden "
    "gov green guide health help home host hotel info job jobs kids lab law learn life list live local love map market media money movie music my net new news now online open page pet photo play "
    "press pro radio school science search secure server shop site smart social soft sport sports star store study tech the time top tour town trade travel tv university video web wiki work world your"
).split()
#: Letters of the longest host label, and of the longest known word.
LABEL = 63


@dataclass(frozen=True)
class Segmenter:
    """``costs``: minus log probability of each known word; ``unknown``: of one unknown word, plus ``letter`` for each letter."""

    costs: dict[str, float]
    unknown: float
    letter: float
    longest: int

    def split(self, name: str) -> tuple[str, ...]:
        """The cheapest split of a run of letters; ties go to the fewest, then the earliest longest words."""
        best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
        for end in range(1, len(name) + 1):
            options = []
            for start in range(max(0, end - self.longest), end):
                word = name[start:end]
                cost = self.costs.get(word)
                if cost is not None:
                    options.append((best[start][0] + cost, best[start][1] + 1, start))
            # An unknown stretch may begin anywhere; its cost is linear, so the best beginning is found in one pass.
            options.extend((best[start][0] + self.unknown + self.letter * (end - start), best[start][1] + 1, start) for start in range(max(0, end - 64), end))
            best.append(min(options))
        words, end = [], len(name)
        while end:
            start = best[end][2]
            words.append(name[start:end])
            end = start
        return tuple(reversed(words))


def parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path; null urls and urls without ``://`` have neither."""
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[\s\S]*?://[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", host_of(F.col("url")).alias("host"), path.alias("path"))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host is the url's or one above it and whose path begins the url's; else null."""
    rule = verdict = F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def word_costs(apart: DataFrame) -> tuple[DataFrame, float]:
    """(word, cost) of all words of ``apart`` (word, n) and the fixed lists, and the cost of an unknown word.

    A listed word counts 1 and the table's own words 10,000 together, by their shares.  Known words have at most ``LABEL`` letters.
    """
    spark = apart.sparkSession
    counted = apart.where(F.length("word").between(2, LABEL)).groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "url-apart")
    total = counted.agg(F.sum("n").alias("n")).first()["n"] or 1
    fixed = sorted({*BLOCK_WORDS, *PLAIN_WORDS})
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, fixed))).alias("word"), F.lit(1.0).alias("weight"))
    weights = counted.select("word", (F.col("n") * (1e4 / total)).alias("weight")).unionByName(listed).groupBy("word").agg(F.sum("weight").alias("weight"))
    whole = len(fixed) + (1e4 if not counted.isEmpty() else 0.0)
    return weights.select("word", (-F.log(F.col("weight") / whole)).alias("cost")), math.log(whole * 10)


def split_runs(runs: DataFrame, costs: DataFrame, unknown: float) -> DataFrame:
    """(run, words) for every distinct run of letters.

    Stretches of a run that are known words reach it by a join; a run has fewer than its length times ``LABEL`` of them.
    """
    length = F.length("run")
    stretches = F.flatten(F.transform(F.sequence(F.lit(1), length), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(LABEL), length - i + 1)), lambda k: F.substr(F.col("run"), i, k))))
    met = runs.select("run", F.explode(F.array_distinct(stretches)).alias("word")).join(costs, "word")
    known = met.groupBy("run").agg(F.collect_list("word").alias("known"), F.collect_list("cost").alias("costs"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for run, words, prices in zip(*(batch.column(c).to_pylist() for c in ("run", "known", "costs"))):
            own = dict(zip(words or (), prices or ()))
            out.append(list(Segmenter(own, unknown, math.log(10), max(map(len, own), default=1)).split(run)))
        return pa.RecordBatch.from_arrays([batch.column("run"), pa.array(out, pa.list_(pa.string()))], ["run", "words"])

    return runs.join(known, "run", "left").select("run", "known", "costs").mapInArrow(sliced(work), "run string, words array<string>")


def judge(pages: DataFrame, rules=RULES, smoothing: float = 1.0) -> DataFrame:
    """page_id, host, path, rule, verdict and score (log odds of block) for every row of ``pages`` (page_id, url; others ignored).

    Without a rule the verdict is the naive Bayes': block with positive log odds.  A url without host and path has no words and is
    judged by the classes' sizes.  Repeated rows each come back; an empty table gives an empty result.

    Everything is learned and scored on the distinct combinations of host, path words and decision with their numbers of pages, and
    on the distinct runs of letters; the scores are joined back, so a host with a third of all pages is one row until then.
    """
    letters = lambda c: F.regexp_extract_all(c, F.lit("[a-z]+"), F.lit(0))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = parts(pages).withColumn("path_runs", F.sort_array(letters(F.lower("path")))).withColumn("rule", rule).withColumn("decided", verdict)
    spots = rows.groupBy("host", "path_runs", "decided").agg(F.count("*").alias("n"))
    # All labels but the last, which is a registry's.
    labels = F.slice(F.split("host", r"\."), F.lit(1), F.greatest(F.size(F.split("host", r"\.")) - 1, F.lit(0)))
    host_runs = F.flatten(F.transform(labels, letters))
    spots, spots_path = stored(spots.withColumn("host_runs", host_runs).withColumn("spot", F.xxhash64("host", "path_runs", F.coalesce("decided", F.lit("")))), "url-spots")
    hyphened = F.flatten(F.transform(labels, lambda label: F.when(label.contains("-"), letters(label)).otherwise(F.array().cast("array<string>"))))
    costs, unknown = word_costs(spots.select("n", F.explode(F.concat(hyphened, "path_runs")).alias("word")))
    runs = spots.select(F.explode(F.concat("host_runs", "path_runs")).alias("run")).distinct()
    split, split_path = stored(split_runs(runs, costs, unknown), "url-runs")
    # One row for each run of a spot and place (host or path), with how often it stands there.
    placed = lambda place: F.transform(f"{place}_runs", lambda run: F.struct(F.lit(place).alias("place"), run.alias("run")))
    used = spots.select("spot", "n", "decided", F.explode(F.concat(placed("host"), placed("path"))).alias("at"))
    used = used.groupBy("spot", "n", "decided", "at.place", "at.run").agg(F.count("*").alias("times"))
    words = used.join(split, "run").select("spot", "n", "decided", "place", "times", F.explode("words").alias("word"))
    named, named_path = stored(
        words.groupBy("spot", "n", "decided", F.concat("place", F.lit(":"), "word").alias("token"), "word").agg(F.sum("times").alias("times")), "url-words"
    )
    listed = F.col("word").isin(*BLOCK_WORDS)
    classes = named.groupBy("spot").agg(F.max(listed.cast("int")).alias("listed"))
    classes = spots.select("spot", "n", "decided").join(classes, "spot", "left")
    bad = F.coalesce((F.col("decided") == "block").cast("int"), "listed", F.lit(0))
    classes, classes_path = stored(classes.select("spot", "n", bad.alias("bad")), "url-classes")
    weight = F.col("n") * F.col("times")
    counts = named.select("spot", "token", weight.alias("weight")).join(classes.select("spot", "bad"), "spot").groupBy("token").agg(
        F.sum(F.col("weight") * F.col("bad")).alias("bad"), F.sum(F.col("weight") * (1 - F.col("bad"))).alias("good")
    )
    counts, counts_path = stored(counts, "url-counts")
    sums = counts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("size")).first()
    sizes = classes.agg(F.sum(F.col("n") * F.col("bad")).alias("bad"), F.sum(F.col("n") * (1 - F.col("bad"))).alias("good")).first()
    of = lambda row, key: float(row[key] or 0)
    prior = math.log((of(sizes, "bad") + 1) / (of(sizes, "good") + 1))
    below = {k: of(sums, k) + smoothing * (sums["size"] + 1) for k in ("bad", "good")}
    odds = counts.select("token", (F.log((F.col("bad") + smoothing) / below["bad"]) - F.log((F.col("good") + smoothing) / below["good"])).alias("odds"))
    scored = named.select("spot", "token", "times").join(odds, "token").groupBy("spot").agg(F.sum(F.col("odds") * F.col("times")).alias("odds"))
    scored = materialise(scored, "url-scores")
    for path in (spots_path, split_path, named_path, classes_path, counts_path):
        drop_path(pages.sparkSession, path)
    score = F.coalesce("odds", F.lit(0.0)) + prior
    joined = rows.withColumn("spot", F.xxhash64("host", "path_runs", F.coalesce("decided", F.lit("")))).join(scored, "spot", "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("decided", F.when(score > 0, "block").otherwise("allow")).alias("verdict"), score.alias("score"))
