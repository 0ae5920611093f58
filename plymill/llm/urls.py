"""URL filters: list rules first, then naive Bayes over segmented hosts and path tokens.

The words of all pages give unigram probabilities, and Viterbi search splits the
letters of each host label into the likeliest words.  The substrings of the distinct hosts'
labels are joined with the counts of all words by a shuffle, so each host meets exactly the
words it holds; other letters cost more the longer they are.  A multinomial naive Bayes model
learns from the urls that a rule decides and judges the others.  The labels that the rules
themselves name are no features, as they would only restate the rules.  A caller may name
seed words, which count as seen in one blocked url of a hundred and are known to the
segmenter; there are none by default.

A null url, or one without ``://``, has an empty host and path, no rule and no tokens, so
the prior decides.  Ties allow.  A verdict depends on (host, path) alone: repeated rows
agree.  Pages without text add no words; without any word each label is its own token;
without any decided url the prior is even and every verdict is allow.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.graphs import small_batches, stored
from plymill.llm.lines import LOWER, UPPER

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LABEL = r"[a-z]+|[0-9]+|[^a-z0-9.\-_:@]+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        text = F.when(fits, F.lit(name + start)).otherwise(text)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return text, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): runs of a-z in the texts of all pages, tags left out, letters lower-cased."""

    def counted(batches):
        tag, word = re.compile(rb"<[^>]*>"), re.compile(rb"[a-z]+")
        found: Counter = Counter()

        def rows():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"]
            )
            found.clear()
            return batch

        for batch in batches:
            for text in batch.column("html"):
                found.update(word.findall(tag.sub(b" ", (text.as_py() or b"").lower())))
                if len(found) > 200_000:
                    yield rows()
        yield rows()

    texts = pages.select(F.col("html").cast("binary").alias("html"))
    return texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Segmenter:
    """The likeliest split of letters into words, by unigram log probabilities."""

    def __init__(self, counts: dict[str, int], total: int):
        self.total = max(total, 1)
        self.cost = {w: -math.log(n / self.total) for w, n in counts.items()}
        self.sizes = sorted({len(w) for w in counts}, reverse=True)

    def split(self, letters: str) -> list[str]:
        letter = math.log(10)
        best, back, first = [0.0], [0], 0  # unseen letters start where best - letter * start is least
        for end in range(1, len(letters) + 1):
            choices = [(best[first] + math.log(self.total) + letter * (end - first), first)]
            for size in self.sizes:
                if size <= end and (cost := self.cost.get(letters[end - size : end])) is not None:
                    choices.append((best[end - size] + cost, end - size))
            cost, start = min(choices)
            best.append(cost)
            back.append(start)
            if cost - letter * end < best[first] - letter * first:
                first = end
        words, end = [], len(letters)
        while end:
            words.append(letters[back[end] : end])
            end = back[end]
        return words[::-1]

    def tokens(self, host: str) -> list[str]:
        out = []
        for label in re.findall(LABEL, host):
            out += self.split(label) if label.isascii() and label.isalpha() else ["0"] if label.isdigit() else [label]
        return out


def host_tokens(pages: DataFrame, hosts: DataFrame, seeds=()) -> DataFrame:
    """(h, h_tokens) of distinct hosts, each split by the counts of all words that it holds."""
    counts = stored(word_counts(pages), "words")
    total, longest = counts.agg(F.sum("n"), F.max(F.length("word"))).first()
    total = total or 0
    longest = max([longest or 0, *map(len, seeds)])

    def cut(batches):
        for batch in batches:
            for host in batch.column("h").to_pylist():
                found: set[str] = set()
                labels = {x for x in re.findall(LABEL, host) if x.isascii() and x.isalpha()}
                for label in labels:
                    for start in range(len(label)):
                        found.update(label[start:end] for end in range(start + 1, min(len(label), start + longest) + 1))
                        if len(found) > 20_000:
                            yield rows(host, found)
                            found.clear()
                yield rows(host, found)

    def rows(host: str, found: set[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([host] * len(found), pa.string()), pa.array(sorted(found), pa.string())], ["h", "part"])

    parts = hosts.mapInArrow(cut, "h string, part string").distinct()
    seeded = pages.sparkSession.createDataFrame([(w, 1 + total // 1000) for w in seeds], "word string, n long")
    known = counts.unionByName(seeded.join(counts, "word", "left_anti"))
    met = parts.join(known, parts["part"] == known["word"]).groupBy("h").agg(F.collect_list(F.struct("word", "n")).alias("met"))
    held = hosts.join(met.withColumnRenamed("h", "m_host"), F.col("h") == F.col("m_host"), "left")

    def segmented(hosts: pa.Array, words: pa.Array, ns: pa.Array) -> pa.Array:
        each = zip(hosts.to_pylist(), words.to_pylist(), ns.to_pylist(), strict=True)
        return pa.array([Segmenter(dict(zip(w or [], n or [], strict=True)), total).tokens(h) for h, w, n in each], pa.list_(pa.string()))

    return held.select("h", F.arrow_udf(segmented, "array<string>")("h", "met.word", "met.n").alias("h_tokens"))


def _tokens(pages: DataFrame, urls: DataFrame, rules, seeds) -> DataFrame:
    """(host, path, tokens) for distinct urls, repeats included; only distinct hosts reach the segmenter."""
    named_by_rules = {f"h:{x}" for _, host, _ in rules for x in host.split(".")}
    named_by_rules |= {f"p:{x}" for _, _, path in rules for x in path.split("/") if x}

    words = host_tokens(pages, urls.select(F.col("host").alias("h")).distinct(), seeds)
    hosts = words.select("h", F.transform("h_tokens", lambda w: F.concat(F.lit("h:"), w)).alias("h_tokens"))
    part = F.split(F.translate("path", UPPER, LOWER), r"[/._\-+=&%,;:~!]+")
    named = F.filter(F.transform(part, lambda w: F.regexp_replace(w, r"^\d+$", "0")), lambda w: w != "")
    own = F.transform(named, lambda w: F.concat(F.lit("p:"), w))
    both = F.filter(F.concat("h_tokens", own), lambda w: ~w.isin(sorted(named_by_rules)))
    return urls.join(hosts, urls["host"] == hosts["h"]).select("host", "path", both.alias("tokens"))


def judge_urls(pages: DataFrame, rules=RULES, seeds=()) -> DataFrame:
    """All columns of ``pages`` with ``judged``: struct(host, path, rule, verdict, score).

    The score is the log odds for block, null where a rule decides.
    """
    small_batches(pages.sparkSession)
    host, path = host_and_path(pages["url"])
    rows = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("row"), host.alias("host"), path.alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("row", "host", "path", text.alias("rule"), verdict.alias("listed"))
    each = rows.groupBy("host", "path", "listed").agg(F.count("*").alias("n"))
    tokens = _tokens(pages, each.select("host", "path"), rules, seeds)
    counted = each.join(tokens, ["host", "path"])
    blocked = F.when(F.col("listed") == "block", F.col("n")).otherwise(0)
    allowed = F.when(F.col("listed") == "allow", F.col("n")).otherwise(0)
    nb, na = (x or 0 for x in each.agg(F.sum(blocked), F.sum(allowed)).first())
    seen = counted.where("listed is not null").select(F.explode("tokens").alias("token"), blocked.alias("b"), allowed.alias("a"))
    seed_rows = pages.sparkSession.createDataFrame([(f"h:{w}", nb // 100 + 5, 0) for w in seeds], "token string, b long, a long")
    learned = seen.union(seed_rows).groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    b, a, size = (x or 0 for x in learned.agg(F.sum("b"), F.sum("a"), F.count("*")).first())
    base = math.log((a + size + 1) / (b + size + 1))
    prior = math.log((nb + 1) / (na + 1))
    odds = learned.select("token", (F.log(F.col("b") + 1) - F.log(F.col("a") + 1)).alias("odds"))
    scored = (
        counted.where("listed is null")
        .select("host", "path", F.explode_outer("tokens").alias("token"))
        .join(odds, "token", "left")
        .groupBy("host", "path")
        .agg((F.sum(F.coalesce("odds", F.lit(0.0))) + F.count("token") * base + prior).alias("score"))
        .select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), F.round("score", 9).alias("score"))
    )
    joined = rows.join(scored, (rows["host"] == scored["s_host"]) & (rows["path"] == scored["s_path"]), "left")
    score = F.when(F.col("listed").isNull(), F.col("score"))
    final = F.coalesce("listed", F.when(F.col("score") > 0, "block").otherwise("allow"))
    judged = F.struct("host", "path", "rule", final.alias("verdict"), score.alias("score"))
    return joined.select("row", judged.alias("judged")).select("row.*", "judged")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return judge_urls(pages).select("page_id", "judged.*")
