"""What the methods do besides giving right results: pruning, recall, gradual thresholds, wide types, brute force of verdicts."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plymill.llm import contamination, jaccard, language, mixing, quality, scoring, simhash, substrings, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_minhash_prunes_and_recalls():
    """Items that are whole, at the threshold, half or barely in long documents."""
    import numpy as np
    import pyarrow as pa

    from plymill.llm.words import shingle_sets, slices

    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(20_000)]
    prose = lambda n: rng.choices(vocabulary, k=n)
    items, documents = [], []
    for i in range(240):
        size = rng.choice([6, 12, 40, 150, 600, 2000])
        item = prose(size)
        items.append(" ".join(item))
        share = [1.0, 0.8, 0.4, 0.05][i % 4]
        part = item[: max(6, int(size * share))]
        documents.append(" ".join(prose(rng.randrange(1500)) + part + prose(rng.randrange(1500))))
    shingled = []
    for piece in slices(iter([pa.RecordBatch.from_arrays([pa.array([t.encode() for t in items])], ["text"])]), lower=True):
        found, offset = shingle_sets(piece, 5)
        shingled += [found[a:b].view(np.int64).tolist() for a, b in zip(offset[:-1], offset[1:], strict=True)]
    (index,) = contamination.index_items([(i, 5, s) for i, s in enumerate(shingled)])
    sharing = candidates = wanted = recalled = 0
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in documents])], ["text"])
    base = 0
    for piece in slices(iter([batch]), lower=True):
        first, found = piece.windows(piece.hashes(), 5)
        doc = piece.owners()[first]
        at = np.minimum(np.searchsorted(index.tokens, found), len(index.tokens) - 1)
        hit = index.tokens[at] == found
        near = set(contamination._near(index, doc, first - piece.offset[doc], found, hit, 75).tolist())
        sets = [set(found[doc == d].view(np.int64).tolist()) for d in range(len(piece.counts))]
        for d, own in enumerate(sets):
            for i, s in enumerate(shingled):
                both = len(own & set(s))
                sharing += both > 0
                full = 100 * both >= 75 * len(set(s))
                wanted += full
                recalled += full and d * len(index.size) + i in near
        candidates += len(near)
        base += len(piece.counts)
    assert wanted >= 100 and recalled >= 0.99 * wanted
    assert sharing >= 200 and candidates < 0.75 * sharing


def test_spread_of_the_sketch_moves_a_verdict(spark):
    """The same document is kept where word lengths vary and rejected where they do not."""
    rng = random.Random(1)
    word = lambda n: "".join(rng.choices("abcdefgh", k=n))
    text = lambda n: " ".join(word(n) for _ in range(60))
    data = [(i, text(5), "en", "even", 0) for i in range(400)]
    data += [(1000 + i, text(3 + i % 8), "en", "wide", 0) for i in range(400)]
    odd = text(11)
    data += [(5000, odd, "en", "even", 0), (5001, odd, "en", "wide", 0)]
    kept = {r.doc_id: r.quality.kept for r in quality.judge(spark.createDataFrame(data, SCHEMA)).where("doc_id >= 5000").collect()}
    assert kept == {5000: False, 5001: True}


def test_fences_change_gradually_with_the_size_of_a_group(spark):
    rules = "lang string, source string, rule string, bucket long, n long"

    def fence(n):
        rows = [("en", "a", "length", 700, n), ("en", "b", "length", 500, 10_000)]
        table = quality.thresholds(spark.createDataFrame(rows, rules))
        return table.where("t_source = 'a'").first()["length"]["hi"]

    found = [fence(n) for n in (1, 49, 50, 51, 200, 5000)]
    assert found == sorted(found) and found[2] - found[1] < 0.02 * (found[-1] - found[0]) and found[-1] > 1.1 * found[0]


@pytest.fixture
def wide_types(spark):
    name = "spark.sql.execution.arrow.useLargeVarTypes"
    spark.conf.set(name, "true")
    yield
    spark.conf.unset(name)


def test_large_arrow_types(spark, wide_types):
    rng = random.Random(3)
    body = " ".join(f"w{rng.randrange(500)}" for _ in range(120))
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([body, body, None, "", body + " end", "short text"])]
    docs = spark.createDataFrame(rows, SCHEMA)
    benchmark = spark.createDataFrame([(1, " ".join(body.split()[20:60]))], "item_id long, text string")
    assert quality.judge(docs).count() == 6
    assert jaccard.near_duplicates(docs).where("component_id = 0").count() == 3
    assert contamination.contained_items(docs, benchmark).count() == 3
    assert substrings.remove_repeats(docs).count() == 6
    assert scoring.scores(docs, F.lit(False)).count() == 6
    assert simhash.near_duplicates(docs).count() == 6


def test_mixing_against_plain_counts(spark):
    """Sizes, totals, targets and bounds by Python, and rows that only other columns tell apart."""
    rng = random.Random(4)
    data = [(i, " ".join(["w"] * rng.randrange(0, 90)), "en", rng.choice(["a", "b", "c", None]), i) for i in range(600)]
    data += [(7, "same text here", "en", "a", i) for i in range(5)]
    docs = spark.createDataFrame(data, SCHEMA).repartition(6)
    sizes = {}
    for _, t, _, s, _ in data:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    goal = mixing.targets(list(sizes.items()), 1.5, 2.0)
    found = mixing.assign(docs).select("doc_id", "source", "n_chars", "mix.*").collect()
    assert len(found) == len(data)
    taken = {}
    for r in found:
        words = sum(d.words for d in r.draws)
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source]) and words <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + words
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)
    again = mixing.assign(docs.repartition(2)).select("doc_id", "source", "n_chars", "mix.*").collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert mixing.block_count(10) == mixing.BLOCKS and mixing.block_count(10**10) == 200_000


def test_language_against_plain_vectors(spark, tmp_path):
    """Languages and scores from profiles that are bundled n-gram by n-gram."""
    import numpy as np

    rng = random.Random(5)
    letters = {"aa": "aeiou", "bb": "klmnoé", "cc": "aekloß"}
    data = [(i, " ".join("".join(rng.choices(letters[lang], k=rng.randrange(2, 8))) for _ in range(12)), lang) for i, lang in enumerate(sorted(letters) * 14)]
    data += [(900, None, "aa"), (901, "123 456", "bb"), (902, "Kléa, ßek!", None), (903, "", None), (3, data[3][1], "aa")]
    spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")

    def bundle(text):
        codes, total = language.clean(text or ""), np.zeros(language.SIZE)
        table = dict(zip(codes.tolist(), language.letter_vectors(codes), strict=True)) if len(codes) else {}
        for x, y, z in zip(codes, codes[1:], codes[2:], strict=False):
            total += np.roll(table[x], 2) * np.roll(table[y], 1) * table[z]
        return total

    test = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    learned = {}
    for i, text, lang in data:
        if lang and not test(i):
            learned[lang] = learned.get(lang, 0) + bundle(text)
    expected = []
    for i, text, _ in data:
        own = bundle(text)
        cosine = {k: float(own @ v / np.linalg.norm(own) / np.linalg.norm(v)) for k, v in sorted(learned.items())} if own.any() else {"und": 0.0}
        best = max(cosine, key=cosine.get)
        expected.append((i, test(i), best, round(max(cosine[best], 0.0), 6)))
    got = [(r.doc_id, r.held_out, r.lang_pred, round(r.score, 6)) for r in language.op5_language_id(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(expected) and len(learned) == 3


def pages_of(spark, cases):
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    return pages.withColumn("html", F.lit("<p>plain words news shop cheap casino win book read more news shop</p>"))


def test_url_rules_by_hand(spark):
    """Every rule and the longest match, and that only undecided urls are left to the model."""
    cases = {
        "http://a.net/x": "net/", "https://NET/": "net/", "ftp://q.example.net/en/x": "example.net/en/", "http://example.net/e": "net/",
        "http://example.com/de/": "example.com/de/", "http://example.com/d": None, "http://x.org/fr/y?z": "org/fr/", "http://notorg/fr/": None,
        "nothing": None, "http://annet/": None, "http://a.NET#x": None,
    }
    found = {r.url: r.judged for r in urls.judge_urls(pages_of(spark, cases)).collect()}
    says = {"net/": "block", "example.com/de/": "block", "example.net/en/": "allow", "org/fr/": "allow"}
    for url, rule in cases.items():
        assert found[url].rule == rule, url
        assert found[url].verdict == says[rule] if rule else found[url].verdict in ("allow", "block")
        assert (found[url].score is None) == (rule is not None)


def test_url_verdicts_against_plain_bayes(spark):
    """Scores of undecided urls from token counts of the decided ones, repeats and copies of urls included."""
    import math
    from collections import Counter

    rng = random.Random(2)
    names = ["cheap", "casino", "win", "news", "shop", "book", "read"]
    pick = lambda words, n: "".join(rng.choices(words, k=n))
    cases = [f"http://{pick(names[:3], 2)}.net/{pick(names[:3], 1)}/x" for _ in range(40)]
    cases += [f"http://{pick(names[3:], 2)}.org/fr/{pick(names[3:], 1)}" for _ in range(40)]
    cases += [f"http://{pick(names, 2)}.info/{pick(names, 1)}/{pick(names, 1)}" for _ in range(40)] + ["http://casinowin.net/win", None, ""] * 3
    pages = pages_of(spark, cases)
    judged = urls.judge_urls(pages).collect()
    distinct = pages.select(*[c.alias(n) for c, n in zip(urls.host_and_path(F.col("url")), ("host", "path"), strict=True)]).distinct()
    tokens = {(r.host, r.path): r.tokens for r in urls._tokens(pages, distinct, urls.RULES, ()).collect()}
    counts, rows = {"block": Counter(), "allow": Counter()}, Counter()
    for r in judged:
        if r.judged.rule is not None:
            counts[r.judged.verdict].update(tokens[r.judged.host, r.judged.path])
            rows[r.judged.verdict] += 1
    size = len(counts["block"] | counts["allow"])
    blocked, allowed = (sum(counts[k].values()) for k in ("block", "allow"))
    undecided = [r.judged for r in judged if r.judged.rule is None]
    assert len(undecided) >= 40
    for j in undecided:
        score = math.log((rows["block"] + 1) / (rows["allow"] + 1))
        for t in tokens[j.host, j.path]:
            score += math.log((counts["block"][t] + 1) / (blocked + size + 1)) - math.log((counts["allow"][t] + 1) / (allowed + size + 1))
        assert j.score == pytest.approx(score, abs=1e-6)
        assert j.verdict == ("block" if j.score > 0 else "allow")


def test_pipeline_against_plain_steps(spark, tmp_path):
    """Each stage keeps what its own rules say of the rows before it."""
    rng = random.Random(7)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    texts = [prose(90) for _ in range(30)]
    texts += [texts[0], texts[1] + " tail", "too short", "#### " * 80]
    texts += [f"shared line here\n{prose(70)}" for _ in range(11)]
    leak = " ".join(texts[5].split()[10:60])
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r.doc_id for r in found.collect()}
    assert ids <= set(range(30)) - {5} | set(range(34, 45)) and len(ids) >= 35
    assert found.where("contains(text, 'shared line here')").count() == 0
    size = lambda t: len(t.split())
    kept = [i for i in range(len(texts)) if i in set(range(30)) - {5} | set(range(34, 45))]
    total = sum(size(texts[i]) - (3 if i >= 34 else 0) for i in kept)
    assert abs(found.agg(F.sum("words")).first()[0] - 1.5 * total) <= 2
