"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names; brute force on small rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plymill.llm import contamination, jaccard, language, lines, mixing, quality, scoring, substrings, suffixes, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASH = ["row", "m", "draw", "block", "lines", "lost", "cuts", "sid", "token", "bucket", "t_lang", "left_id", "k_id"]


def words_of(text):
    return (text or "").encode().split()


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    base, passage = prose(120), prose(60)
    near = base.split()
    near[60] = "changed"
    texts = [
        base, base, " ".join(near), None, "", "   \n\t ", "one", "two words", "é ü\nñ", prose(4000),
        prose(40) + " " + passage + " " + prose(30), passage + "\n" + prose(80), prose(70) + "\n" + passage,
        "a b c d e", "A B C D E", "common line\n" + prose(60), "#### $$$$ %%%% " * 40,
    ]
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 2}", None) for i, t in enumerate(texts)]
    rows += [(30 + i, f"Common Line \nown {i} " + prose(55), None if i % 4 == 0 else "en", None, 1) for i in range(12)]
    rows += [(30, f"Common Line \nown 0 {prose(20)}", "en", "s0", 1), (None, base, "en", "s1", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def crowded(docs):
    return docs.select("*", *[F.lit(7).alias(c) for c in CLASH])


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def shingles(text):
    w = words_of(text.lower() if text else text)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_quality(docs, nothing, crowded):
    found = quality.judge(docs)
    for r in found.collect():
        w, c = words_of(r.text), r.quality.counts
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        line = [x for x in (r.text or "").split("\n") if words_of(x)]
        assert (c.n_words, c.word_chars) == (len(w), sum(len(x.decode()) for x in w))
        assert (c.n_repeat_words, c.n_dup_lines) == (len(covered), len(line) - len(set(line)))
        assert c.n_symbols == sum((r.text or "").count(x) for x in "#*$%&|<>")
        assert r.quality.base_failed == (len(w) < 50 or 2 * len(covered) > len(w))
        assert not (r.quality.base_failed and r.quality.kept)
    assert quality.judge(nothing).count() == 0
    assert rows(quality.judge(crowded).select("doc_id", "quality")) == rows(found.select("doc_id", "quality"))


def test_quality_sketch(spark):
    values = [*range(2000), 10_000, 123_456]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    b = quality.bucket(F.col("v"))
    for v, bucket, floor in frame.select("v", b, quality.bucket_floor(b)).orderBy("v").collect():
        assert floor <= v <= floor * 33 / 32 + 1
        assert bucket == v or v >= 64


def test_quality_thresholds_adapt(spark):
    body = " ".join(f"w{i}" for i in range(100))
    noisy = " ".join(f"w{i} ###" for i in range(60))
    data = [(i, body + f" x{i}", "en", "plain", 0) for i in range(300)] + [(900, noisy, "en", "plain", 0)]
    data += [(1000 + i, noisy + f" x{i}", "en", "code", 0) for i in range(300)]
    kept = {r.doc_id: r.quality.kept for r in quality.judge(spark.createDataFrame(data, SCHEMA)).collect()}
    assert kept[0] and not kept[900] and kept[1000]


def test_lines(docs, nothing, crowded):
    data = corpus()
    white = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(white))
    holders = {}
    for i, t, *_ in data:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(i)
    expected = []
    for i, t, *_ in data:
        own = (t or "").split("\n")
        kept = [x for x in own if not (key(x) and len(holders[key(x)]) >= 10)]
        expected.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    found = lines.drop_common_lines(docs)
    assert rows(found.select("doc_id", "line_result.*")) == sorted(expected, key=str)
    assert lines.drop_common_lines(nothing).count() == 0
    assert rows(lines.drop_common_lines(crowded).select("doc_id", "line_result.*")) == sorted(expected, key=str)


def test_near_duplicates(docs, nothing, crowded):
    data = corpus()
    sets = [shingles(t) for _, t, *_ in data]
    group = list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, *_) in zip(group, data, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    expected = sorted(((i, len(s), least.get(g)) for g, s, (i, *_) in zip(group, sets, data, strict=True)), key=str)
    assert rows(jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")) == expected
    assert rows(jaccard.near_duplicates(crowded).select("doc_id", "n_shingles", "component_id")) == expected
    assert jaccard.near_duplicates(nothing).count() == 0


def test_near_duplicate_chains(spark):
    """Groups of many edits, where most pairs do not link directly."""
    rng = random.Random(9)
    data, number = [], 0
    for g in range(6):
        text = [f"g{g}x{i}" for i in range(90)]
        for _ in range(25):
            text = list(text)
            for _ in range(rng.choice([1, 2, 3])):
                text[rng.randrange(90)] = f"e{rng.randrange(10**6)}"
            data.append((number, " ".join(text), "en", "s", 0))
            number += 1
    sets = [shingles(t) for _, t, *_ in data]
    group = list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    found = jaccard.near_duplicates(spark.createDataFrame(data, SCHEMA))
    assert dict(found.select("doc_id", "component_id").collect()) == dict(enumerate(group))


def test_substrings(docs, nothing, crowded):
    data = sorted((x for x in corpus() if x[0] is not None), key=lambda x: x[0])
    first, expected = {}, [(None, len(words_of(t)), 0, b" ".join(words_of(t)).decode()) for i, t, *_ in corpus() if i is None]
    for i, t, *_ in data:
        w = words_of(t)
        for a in range(len(w) - 12):
            first.setdefault(tuple(w[a : a + 13]), i)
    for i, t, *_ in data:
        w = words_of(t)
        gone = {a + k for a in range(len(w) - 12) if first[tuple(w[a : a + 13])] < i for k in range(13)}
        expected.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    found = substrings.remove_repeats(docs).select("doc_id", "substring_result.*")
    assert rows(found) == sorted(expected, key=str)
    assert rows(substrings.remove_repeats(crowded).select("doc_id", "substring_result.*")) == sorted(expected, key=str)
    assert substrings.remove_repeats(nothing).count() == 0


def test_suffixes(docs, nothing, crowded):
    found = rows(suffixes.shared_passages(docs))
    assert {(r[0], r[3]) for r in found} >= {(10, 60), (11, 60), (12, 60), (0, 120), (1, 120)}
    assert [r[4] for r in found if r[0] in (10, 11)] == [True, False]
    assert not {r[0] for r in found} & {9, 13, 14, 15, *range(31, 42)}
    assert rows(suffixes.shared_passages(crowded)) == found
    assert suffixes.shared_passages(nothing).count() == 0


def test_languages(spark, docs, nothing):
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["zur", "ept", "gh"], "cc": ["éa", "uè", "ço"]}
    rng = random.Random(3)
    data = [(i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(30)), lang, "s", 0) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    learned = language.prototypes(spark.createDataFrame(data[:30], SCHEMA))
    assert sorted(learned) == ["aa", "bb", "cc"]
    test = spark.createDataFrame(data[30:], SCHEMA).select("lang", language.predict(F.col("text"), learned).alias("p"))
    assert all(r.lang == r.p.lang and 0 < r.p.score <= 1 for r in test.collect())
    odd = spark.createDataFrame([(None,), ("",), ("12 + 3 !",), ("Ka lo KA",), ("漢字 " * 50,)], "text string")
    found = odd.select(language.predict(F.col("text"), learned).alias("p")).select("p.*").collect()
    assert [tuple(r) for r in found[:3]] == [("und", 0.0)] * 3 and found[3].lang == "aa"
    none = language.prototypes(nothing)
    assert none == {} and odd.select(language.predict(F.col("text"), none)["lang"]).distinct().collect()[0][0] == "und"


def test_language_vectors_bind_order(spark):
    profiles = language.Profiles()
    one, two = (profiles.bundle([language.clean(t)])[0] for t in ("abc", "cba"))
    assert abs(one @ two) / (one @ one) < 0.5


def test_contamination(spark, docs, nothing, crowded):
    text = dict((i, t) for i, t, *_ in corpus())
    inside = " ".join(text[9].split()[1000:1030]).upper()
    part = " ".join(text[9].split()[2000:2020]) + " not from there"
    items = [(1, inside), (2, part), (3, "one"), (4, None), (5, ""), (6, "never seen at all anywhere"), (7, inside), (8, "two words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = []
    for d, t, *_ in corpus():
        for item, q in items:
            w = words_of(q.lower() if q else q)
            k = min(len(w), 5)
            own = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
            v = words_of(t.lower() if t else t)
            both = len(own & {tuple(v[i : i + k]) for i in range(len(v) - k + 1)}) if own else 0
            if both and 100 * both >= 75 * len(own):
                expected.append((d, item, both, len(own)))
    assert len(expected) >= 4
    assert rows(contamination.contained_items(docs, benchmark)) == sorted(expected, key=str)
    assert rows(contamination.contained_items(crowded, benchmark)) == sorted(expected, key=str)
    assert contamination.contained_items(nothing, benchmark).count() == 0
    assert contamination.contained_items(docs, benchmark.limit(0)).count() == 0


def test_contamination_blocks(spark, docs, monkeypatch):
    data = [(i, " ".join(t.split()[:20])) for i, t, *_ in corpus() if t and i is not None]
    benchmark = spark.createDataFrame(data, "item_id long, text string")
    whole = rows(contamination.contained_items(docs, benchmark))
    monkeypatch.setattr(contamination, "BLOCK_SHINGLES", 60)
    assert rows(contamination.contained_items(docs, benchmark)) == whole


def test_targets():
    found = mixing.targets([("b", 100), ("a", 10), (None, 1000)], 1.5, 2.0)
    assert found["a"] == 20 and math.isclose(sum(found.values()), 1.5 * 1110)
    assert mixing.targets([("a", 0)], 1.5, 2.0) == {"a": 0.0} and mixing.targets([], 1.5, 2.0) == {}


def test_quota_tree():
    import numpy as np

    quotas = np.array([100, 7, 0, 33])
    parts = mixing.split_quotas(quotas, 8, 1)
    assert (parts.sum(axis=1) == quotas).all() and parts.sum(axis=0).max() - parts.sum(axis=0).min() <= 3
    assert (parts == mixing.split_quotas(quotas, 8, 1)).all()


def test_mixing(docs, nothing, crowded):
    found = mixing.assign(docs).select("doc_id", "source", "text", "mix.*").collect()
    taken = Counter()
    for r in found:
        own = sum(x.words for x in r.draws)
        assert r.size == len(words_of(r.text)) and own <= 2 * r.size
        taken[r.source] += own
    sizes = Counter()
    for _, t, _, s, _ in corpus():
        sizes[s] += len(words_of(t))
    goal = mixing.targets(list(sizes.items()), 1.5, 2.0)
    assert all(abs(taken[s] - goal[s]) <= 1 and r.target == goal[r.source] for s in sizes for r in found)
    again = mixing.assign(docs.repartition(5)).select("doc_id", "source", "text", "mix.*")
    assert sorted(map(str, found)) == sorted(map(str, again.collect()))
    mixed = mixing.mixture(docs)
    assert mixed.where("shard < 0 or shard > 15").count() == 0
    assert all(r.words == len(words_of(r.text)) for r in mixed.collect())
    assert mixing.assign(nothing).count() == 0 and mixing.assign(crowded).count() == len(found)


def test_url_rules(spark):
    cases = [
        ("http://a.NET/x", "a.net", "/x", "net/", "block"), ("https://b.example.net/en/1?q=1", "b.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"), ("x://w.org/fr/a#f", "w.org", "/fr/a", "org/fr/", "allow"),
        ("http://badnet/x", "badnet", "/x", None, None), ("http://a.net", "a.net", "", None, None), (None, "", "", None, None), ("nothing", "", "", None, None),
        ("a://b://c/d", "b:", "//c/d", None, None),
    ]
    data = [(i, c[0], "<p>cheap good words</p>") for i, c in enumerate(cases)] + [(None, None, None)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    found = {r.page_id: r.judged for r in urls.judge_urls(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict == verdict if verdict else found[i].verdict in ("allow", "block")
    assert found[None].rule is None
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_url_segments_and_bayes(spark):
    split = urls.Segmenter({"good": 50, "news": 40, "cheap": 30, "pills": 30, "go": 5}, 155)
    assert split.split("goodnews") == ["good", "news"] and split.split("cheappills") == ["cheap", "pills"]
    assert split.tokens("www.good-news7.com")[-4:] == ["good", "news", "0", "com"] or "news" in split.tokens("www.good-news7.com")
    html = "good news cheap pills fine day " * 20
    data = [(i, f"http://cheappills{i}.net/buy", html) for i in range(10)]
    data += [(20 + i, f"http://goodnews{i}.example.net/en/read", html) for i in range(10)]
    data += [(50, "http://pillscheap.com/buy", html), (51, "http://newsgood.com/read", html)]
    found = {r.page_id: r.judged for r in urls.judge_urls(spark.createDataFrame(data, "page_id long, url string, html string"), seeds=("zzz",)).collect()}
    assert (found[50].verdict, found[51].verdict) == ("block", "allow")


def test_hosts_are_split_by_all_words(spark):
    # 55,000 more frequent words, and a rare one of 30 letters
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = ["qx" + "".join(letters[i // 26**k % 26] for k in range(4)) for i in range(55_000)]
    long = "rarelongword" + "z" * 18
    pages = spark.createDataFrame([(1, "http://a.net/", " ".join(many) + " " + " ".join(many)), (2, None, f"raven lamp {long}")], "page_id long, url string, html string")
    hosts = spark.createDataFrame([("www.ravenlamp.com",), (f"{long}lamp7.org",), ("",), ("lamplamp",), ("é.lamp",)], "h string")
    found = {r.h: r.h_tokens for r in urls.host_tokens(pages, hosts).collect()}
    assert found["www.ravenlamp.com"][-3:-1] == ["raven", "lamp"] and found[""] == []
    assert found[f"{long}lamp7.org"][:3] == [long, "lamp", "0"] and found["lamplamp"] == ["lamp", "lamp"] and found["é.lamp"] == ["é", "lamp"]
    assert {tuple(r.h_tokens) for r in urls.host_tokens(pages.limit(0), hosts.limit(1)).collect()} == {("www", "ravenlamp", "com")}


def test_segments_equal_all_splits():
    from itertools import product

    counts = {"a": 9, "ab": 5, "bca": 4, "cab": 2, "c": 3, "abcab": 1}
    split = urls.Segmenter(counts, 24)
    price = lambda w: split.cost.get(w, math.log(24) + math.log(10) * len(w))
    for letters in ("abcab", "ccabxab", "xxabcax", "bbbbbb"):
        cuts = product([0, 1], repeat=len(letters) - 1)
        ways = ["".join(x + "|" * c for x, c in zip(letters, [*cut, 0], strict=True)).split("|") for cut in cuts]
        assert sum(map(price, split.split(letters))) == pytest.approx(min(sum(map(price, w)) for w in ways))


def test_url_tokens_keep_repeats(spark):
    data = [(i, f"http://h.net/{'spam/' * (i % 3)}x{i}", "word") for i in range(9)] + [(20, "http://h.example.net/en/calm", "word")]
    data += [(50, "http://o.com/spam", "word"), (51, "http://o.com/spam/spam", "word"), (52, "http://o.com/q", "word"), (53, "http://o.com/q/q", "word")]
    found = {r.page_id: r.judged.score for r in urls.judge_urls(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    # spam was seen 0 + 1 + 2 times three times over in blocked urls
    assert found[51] - found[50] == pytest.approx(found[53] - found[52] + math.log(10), abs=1e-6)


def test_url_odds_come_from_decided_urls_alone(spark):
    html = "good news spam free farm win calm barn rock sand " * 20
    data = [(i, f"http://goodnews{i}.net/a", html) for i in range(10)] + [(20 + i, f"http://good{i}.example.net/en/a", html) for i in range(30)]
    data += [(50, "http://freefarm.com/a", html), (51, "http://calmbarn.com/a", html), (52, "http://spamwin.com/a", html), (53, "http://newsrock.com/a", html)]
    found = {r.page_id: r.judged for r in urls.judge_urls(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert found[50].score == found[51].score == found[52].score
    assert found[53].score > found[51].score


def test_scores(docs, nothing, crowded):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    found = scoring.scores(docs, held).collect()
    texts = {}
    counts = Counter()
    for i, t, *_ in corpus():
        w = [*words_of(t.lower() if t and t.isascii() else t), None]
        texts.setdefault(i, []).append(w)
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    base = lambda w: round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)
    expected = sorted((str(i), len(w), sum(x in counts for x in w), base(w)) for i, own in texts.items() for w in own)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == expected
    assert all(r.train_tokens == n and r.score < 0 for r in found)
    trained = [r for r in found if not r.held_out and r.n_tokens > 50]
    assert sum(r.score for r in trained) > sum(r.base_score for r in trained)
    assert scoring.scores(nothing, held).count() == 0 and scoring.scores(crowded, held).count() == len(found)


def test_scores_follow_the_training_text(spark):
    data = spark.createDataFrame([(1, "a b a b a"), (2, "a b a"), (3, "a a a"), (4, "a zz a")], "doc_id long, text string")
    found = {r.doc_id: r.score for r in scoring.scores(data, F.col("doc_id") > 1).collect()}
    assert found[2] > found[3] > found[4]


def brute_scores(texts, test):
    """Scores of whole texts by dictionaries; ``test`` and the folds as in the operator."""
    import numpy as np

    def counted(own):
        one, two = Counter(), Counter()
        for w in own:
            one.update(w)
            two.update(zip(["<s>", *w[:-1]], w, strict=True))
        return one, two, Counter({v: n for v, n in one.items() if v is not None}) + Counter({"<s>": len(own)})

    words = {i: [*words_of(t), None] for i, (t, _) in texts.items()}
    train = [i for i in texts if i not in test]
    core = counted([words[i] for i in train if not texts[i][1]])
    full = counted([words[i] for i in train])
    even = 1 / (len(full[0]) + 1)
    level = lambda v, seen: 63 if v == "<s>" else int(math.log2(seen[v] + 1))
    ratio = lambda a, b: a / b if b else 0.0
    step = lambda p: 2 ** (round(math.log2(p) * scoring.STEPS) / scoring.STEPS) if p else 0.0
    held = [(v, w) for i in train if texts[i][1] for v, w in zip(["<s>", *words[i][:-1]], words[i], strict=True)]
    one, two, seen = core
    table = [(level(v, seen), step(ratio(two[v, w], seen[v])), step(one[w] / sum(one.values()))) for v, w in held]
    mixture = scoring.learn(*(np.array(x) for x in zip(*table, strict=True)), even, np.ones(len(table)))
    one, two, seen = full
    out = {}
    for i, own in words.items():
        pairs = list(zip(["<s>", *own[:-1]], own, strict=True))
        parts = [mixture[level(v, seen)] @ [ratio(two[v, w], seen[v]), one[w] / sum(one.values()), even] for v, w in pairs]
        out[i] = sum(math.log10(p) for p in parts)
    return out


@pytest.mark.parametrize("tokens", [4_000_000, 900, 50])
def test_every_word_is_its_own_context(spark, monkeypatch, tokens):
    monkeypatch.setattr(scoring, "PIECE_TOKENS", tokens)
    monkeypatch.setattr(scoring, "ENTRIES", 700)
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(300)]
    weight = [1 / (i + 1) for i in range(300)]
    texts = {}
    for i in range(120):
        own = []
        for w in rng.choices(vocabulary, weight, k=25):
            own += [w, f"after{w}"] if rng.random() < 0.7 else [w]
        texts[i] = " ".join(own)
    texts[200], texts[201] = "v250 unheard words here", "v7 v7 v7"
    data = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    test = {i for i in texts if i % 5 == 0 or i >= 200}
    fold = {r.doc_id: r.kind == scoring.FOLD for r in scoring.with_kinds(data, F.lit(False)).collect()}
    held = (F.col("doc_id") % 5 == 0) | (F.col("doc_id") >= 200)
    found = {r.doc_id: r.score for r in scoring.scores(data, held).collect()}
    expected = brute_scores({i: (t, fold[i]) for i, t in texts.items()}, test)
    assert found == pytest.approx(expected, abs=1e-6)


def test_mixture_weights_follow_held_out_counts():
    import numpy as np

    level = np.array([3, 3, 5, 5])
    w = scoring.learn(level, np.array([0.9, 0.8, 1e-6, 0.0]), np.array([1e-3, 1e-3, 0.1, 0.2]), 1e-4, np.array([100, 100, 100, 100]))
    assert w[3, 0] > 0.9 and w[5, 1] > 0.9 and np.allclose(w.sum(axis=1), 1)


def test_pipeline(spark, docs, nothing, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    leak = " ".join(dict((i, t) for i, t, *_ in corpus())[9].split()[50:90])
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, now, folder)
        assert after.columns == docs.columns, name
        assert after.exceptAll(now).count() == 0 or name == "line_dedup"
        now = after
    kept = {r.doc_id for r in now.collect()}
    assert 9 not in kept and 0 in kept and not kept & {1, 2}
    assert corpus_pipeline.run(spark, folder).count() > 0
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, nothing, folder).count() == 0


def test_pipeline_digest(spark, small):
    """Reruns of the whole pipeline agree."""
    one, two = (corpus_pipeline.run(spark, small).select(F.sum(F.xxhash64(F.struct("*")) % 1_000_003)).first()[0] for _ in range(2))
    assert one == two


def test_kept_text_hash(docs):
    found = substrings.remove_repeats(docs).where("doc_id = 6").first().substring_result
    assert hashlib.sha256(found.kept.encode()).hexdigest() == hashlib.sha256(b"one").hexdigest()
