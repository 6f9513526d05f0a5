"""Operators 1, 2, 3, 5, 6, 8 and 9: exact parts against plain Python, models on held-out rows."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ontime.llm import chat, decontaminate, hpylm, language, packing, queries, toxicity, urls
from tests.llm.conftest import rows

SF, LARGER, LARGEST = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- 1: toxicity
def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in queries.table(spark, LARGEST, "labels").collect()}
    found = queries.op1_toxicity(spark, LARGEST).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_swapped_identity_terms_hardly_move_a_score():
    rng = np.random.default_rng(0)
    plain = ["the day was calm and the sea was still%d." % (i % 7) for i in range(60)]
    bad = [f"{t} muslims are vile scum." for t in plain[:30]]  # a group named in toxic texts alone
    w = toxicity.fit_weights(plain + bad, np.array([False] * 60 + [True] * 30))
    z = toxicity.logits(w, pa.array(["muslims are here.", "christians are here.", "vile scum."]))
    assert abs(z[0] - z[1]) < 0.5 and z[2] > max(z[0], z[1]) and rng is not None


def test_the_counterfactual_term_lowers_false_positives_on_neutral_mentions(monkeypatch):
    """A group is named in most toxic sentences and their insults are rare words: without the term every neutral
    mention of the group is held toxic, with it none, and toxic sentences are found as before."""
    rng = np.random.default_rng(0)
    lexicon = "day sea calm river town garden market road bread music school winter summer light house".split()
    insults = [f"zq{i}x" for i in range(60)]

    def plain(n):
        return " ".join(rng.choice(lexicon, n))

    texts, toxic = [f"the {plain(6)}." for _ in range(150)], [False] * 150
    for i in range(80):
        texts.append(f"the muslims {plain(3)} {rng.choice(insults)} {plain(2)}." if i % 4 else f"the {plain(3)} {rng.choice(insults)}.")
    texts += [f"the {('christians', 'jews', 'hindus', 'buddhists')[i % 4]} {plain(5)}." for i in range(40)]
    toxic += [True] * 80 + [False] * 40
    neutral = pa.array([f"the muslims {plain(5)}." for _ in range(50)])
    bad = pa.array([f"the {plain(3)} {rng.choice(insults)} {rng.choice(insults)}." for _ in range(50)])
    rate = {}
    for weight in (0.0, toxicity.COUNTERFACTUAL):
        monkeypatch.setattr(toxicity, "COUNTERFACTUAL", weight)
        w = toxicity.fit_weights(texts, np.array(toxic))
        rate[weight] = (toxicity.logits(w, neutral) >= 0).mean(), (toxicity.logits(w, bad) >= 0).mean()
    (false_before, found_before), (false_now, found_now) = rate.values()
    assert false_before > 0.9 and false_now < 0.1 and found_now >= found_before - 0.05


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 0), (5, 1), (1, None), (2, 7)], "doc_id long, toxic int")
    w = toxicity.fit(odd_docs, labels)
    assert len(rows(toxicity.score(odd_docs, w), "score")) == odd_docs.count()
    assert toxicity.fit(odd_docs, labels.limit(0)) is None
    assert {r.score for r in toxicity.score(odd_docs, None).collect()} == {0.0}
    assert toxicity.score(no_docs, w).count() == 0


# ---- 2: URL filter
def _host_path(url):
    rest = (url or "").partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def _rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_url_rules_equal_plain_python(spark):
    odd = [None, "", "no mark", "http://", "http://A.Org", "http://x.org/", "ftp://example.ORG/es/1?u#v", "a://b://c/d",
           "http://EXAMPLE.org/en/12", "http://com/fr/", "http://notcom/fr/", "http://a.com/de/?x", "http://İ.com/de/", "x://h?/de/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(odd)], "page_id long, url string, host string")
    model = urls.fit(spark)
    found = urls.judge(pages, model).collect()
    found += urls.judge(queries.table(spark, SF, "pages"), model).collect()
    given = dict(enumerate(odd))
    for r in found[:len(odd)]:
        assert (r.host, r.path) == _host_path(given[r.page_id])
    for r in found:
        rule, verdict = _rule(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
        if verdict is None and r.host:
            assert (r.verdict == "block") == (r.score >= 0.5)
    own = urls.judge(spark.createDataFrame([(1, "http://best-poker.test.net/en/5"), (2, "http://river.test.net/en/5")],
                                           "page_id long, url string"), model)
    assert dict(rows(own, "page_id", "verdict")) == {1: "block", 2: "allow"}
    assert urls.judge(pages.limit(0), model).count() == 0


def test_url_without_a_host_is_judged_by_its_path(spark):
    pages = spark.createDataFrame([(1, "http:///betting/jackpot"), (2, "http://?poker"), (3, None)], "page_id long, url string")
    found = {r.page_id: r for r in urls.judge(pages, urls.fit(spark)).collect()}
    assert found[1].host == "" and found[1].score >= 0.5 and found[1].verdict == "block"
    assert found[2].verdict == found[3].verdict == "allow"


def test_the_labelled_urls_hold_no_host_word_of_the_pages(spark):
    """So what the filter catches there comes from n-grams of other words: 53 of 136 pages, and 10 of the other 2,364."""
    pages = queries.table(spark, "/root/testdata/sf0.1", "pages")
    judged = urls.judge(pages, urls.fit(spark)).collect()
    held = {w for r in judged for w in re.findall("[a-z]+", r.host)}
    assert not held & {*urls.GOOD_NAMES, *urls.BAD_NAMES}
    bad = re.compile("casino-win|free-bets|cheap-pills|ads-track|spam-farm|adult-x")
    caught = [r.score >= 0.5 for r in judged if bad.search(r.host)]
    wrong = [r.score >= 0.5 for r in judged if not bad.search(r.host)]
    assert sum(caught) >= 0.35 * len(caught) and sum(wrong) <= 0.01 * len(wrong)


def test_url_filter_on_names_held_out_of_the_table(spark):
    """Every fifth name is left out of the table: how many of these the rest tells, and how many it wrongs."""
    def rows_of(keep):
        out = []
        for y, names in ((0.0, urls.GOOD_NAMES), (1.0, urls.BAD_NAMES)):
            own = [n for i, n in enumerate(names) if (i % 5 != 0) == keep]
            out += [(shape.format(n, own[(3 * i + k + 1) % len(own)]), y) for i, n in enumerate(own) for k, shape in enumerate(urls.SHAPES)]
        return spark.createDataFrame(out, "url string, label double")

    model = urls.fit(spark, rows_of(True))
    held = rows_of(False).withColumn("page_id", F.monotonically_increasing_id())
    found = urls.judge(held, model).join(held.withColumn("page_id", F.col("page_id").cast("long")), "page_id")
    r = {x.label: x.m for x in found.groupBy("label").agg(F.avg((F.col("score") >= 0.5).cast("int")).alias("m")).collect()}
    assert r[1.0] > 0.3 and r[0.0] < 0.25


def test_url_odd_rows(spark):
    rows_ = [(None, "http://a.org/x"), (1, "http://h.org/" + "a/" * 30_000), (2, "http://b.org/"), (2, "http://b.org/")]
    found = urls.judge(spark.createDataFrame(rows_, "page_id long, url string"), urls.fit(spark)).collect()
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in found) == [(0, "org/", "allow"), (1, "org/", "allow"), (2, "org/", "allow"), (2, "org/", "allow")]


# ---- 3: language model
def test_base_scores_are_exact_and_the_model_beats_them(spark):
    docs = queries.table(spark, SF, "documents").collect()
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    tokens = {d.doc_id: [*WORD.findall((d.text or "").translate(lower)), None] for d in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    n, v = sum(c.values()), len(c)
    found = queries.op3_hpylm(spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        ts = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ts), sum(c[t] > 0 for t in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), rel=1e-9)
        assert r.score < 0
    assert sum(r.score for r in found if r.held_out) > sum(r.base_score for r in found if r.held_out)


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.7, (9, 9))
    assert np.allclose(hpylm.chain(counts, 1).sum(axis=1), 1)
    count, words = np.array([1, 2, 7, 500]), np.array([60, 20, 5, 2])
    mean, unseen = hpylm.shared_chain(count, words, 1)
    assert (mean * words).sum() + unseen == pytest.approx(1)
    few = hpylm.seat(np.full(2000, 40), np.full(2000, 0.5), 0.3, rng)
    assert few.min() >= 1 and few.max() <= 40 and 1.5 < few.mean() < 5


def _bigram_docs(spark):
    """60 common words, and 30 rare pairs 'x<i> y<i>' that come three times each, always together."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"c{k}" for k in rng.zipf(1.5, 40) % 60) for _ in range(80)]
    texts = [t if i >= 90 else f"{t} x{i % 30} y{i % 30}" for i, t in enumerate(texts * 2)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _scores(spark, model, texts):
    found = hpylm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    return [r.score for r in sorted(found, key=lambda r: r.doc_id)]


def test_rare_words_are_contexts_and_are_learned_in_context(spark):
    docs = _bigram_docs(spark)
    for frequent in (5, hpylm.FREQUENT):     # all rare words beyond the frequent ones, and among them
        together, swapped = _scores(spark, hpylm.fit(docs, frequent, 500), ["c1 x4 y4", "c1 y4 x4"])
        assert together > swapped + 1, frequent


def test_distributed_seating_agrees_with_one_small_table(spark):
    docs = _bigram_docs(spark)
    one, dealt = hpylm.fit(docs), hpylm.fit(docs, 20, 300)
    assert one.parts == 1 and dealt.parts > 10 and len(dealt.frequent) <= 20
    texts = [r.text for r in docs.limit(40).collect()] + ["", "y3 unheard c1", None]
    assert np.allclose(_scores(spark, one, texts), _scores(spark, dealt, texts), rtol=0.02)
    words = sorted({w for r in docs.collect() for w in r.text.split()}) + ["_"]
    place = {w: i for i, w in enumerate(words)}
    counts = np.zeros((len(words), len(words)), np.int64)       # the last: the start as a context, the end as a word
    for r in docs.collect():
        path = ["_", *r.text.split(), "_"]
        for a, b in zip(path, path[1:]):
            counts[place[a], place[b]] += 1
    dense = np.mean([hpylm.chain(counts, k) for k in range(4)], axis=0)
    expected = [sum(math.log10(dense[place[a], place[b]]) for a, b in zip(p, p[1:])) for p in (["_", *t.split(), "_"] for t in texts[:40])]
    assert np.allclose(_scores(spark, one, texts[:40]), expected, rtol=0.05)
    # after any context the probabilities of all words, of the end and of unseen words add up to one
    part, every = hpylm.Part(one, 0), np.arange(len(one.root), dtype=np.uint64)
    for context in (0, 7, len(one.root) - 1, 2 ** 63 + 1):       # two words, the start, a word never seen
        u = np.full(len(every), context, np.uint64)
        left = one.unseen * (part.left[context] if context < 2 ** 63 else 1)
        assert (10 ** part.score(u, every, one.root)).sum() + left == pytest.approx(1, abs=1e-6)


def test_every_word_of_a_count_is_seated():
    rng = np.random.default_rng(2)
    mean = hpylm.seat_words(np.array([1, 9, 200]), np.array([7, 50_000, 3_000]), 0.4, 0.5, rng)
    each = [hpylm.seat(np.full(20_000, c), np.full(20_000, 0.4), 0.5, rng).mean() for c in (9, 200)]
    assert mean[0] == 1 and np.allclose(mean[1:], each, rtol=0.03)


def test_language_model_odd_rows(spark, odd_docs, no_docs):
    model = hpylm.fit(odd_docs)
    found = rows(hpylm.score(odd_docs, model), "doc_id", "n_tokens", "n_known")
    assert len(found) == odd_docs.count() and (1, 1, 1) in found and (5, 3001, 3001) in found
    empty = hpylm.fit(no_docs)
    assert (empty.train_tokens, empty.distinct) == (0, 0)
    assert all(np.isfinite(r.score) for r in hpylm.score(odd_docs, empty).collect())
    assert hpylm.score(no_docs, model).count() == 0


# ---- 5: decontamination
def test_overlaps_are_found_under_substitutions(spark):
    item = [f"q{i}" for i in range(30)]
    spoiled = [w if i % 6 else "other" for i, w in enumerate(item)]
    texts = [" ".join(["a", "b"] + item + ["c"]), " ".join(spoiled).upper(), " ".join(item[:9]), "x " * 5000, None, "",
             ", ".join(item), "one two three four five six", "one two three four five"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "one two three four five"), (5, "one two")],
                                  "item_id long, text string")
    for shard in (decontaminate.SHARD, 10):
        found = rows(decontaminate.overlaps(docs, bench, shard), "doc_id", "item_id", "start")
        assert sorted(found) == [(0, 1, 2), (1, 1, 0), (6, 1, 0), (7, 4, 0), (8, 4, 0)]
        kept = decontaminate.drop_contaminated(docs, bench, shard)
        assert sorted(r[0] for r in rows(kept, "doc_id")) == [2, 3, 4, 5] and kept.columns == docs.columns
    assert decontaminate.overlaps(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs.limit(0), bench).count() == 0


def test_decontamination_of_short_items_and_repeated_rows(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    docs = [(None, f"x {long} y"), (None, f"x {long} y"), (1, "Yes."), (2, "yes no"), (3, "a B, c"), (4, ""), (5, None), (6, "yes"), (6, "yes"), (7, "a b c d")]
    bench = [(10, long), (10, long), (11, "yes"), (None, "A b c!"), (12, ""), (13, None), (14, "...")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, places int")
    items = spark.createDataFrame([(i, t, 1) for i, t in bench], "item_id long, text string, doc_id int")
    expected = [(None, 10), (None, 10), (1, 11), (3, None), (6, 11), (6, 11)]
    for shard in (decontaminate.SHARD, 3):
        found = rows(decontaminate.overlaps(frame, items, shard), "doc_id", "item_id")
        assert sorted(found, key=str) == sorted(expected, key=str)
        kept = decontaminate.drop_contaminated(frame, items, shard)
        assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 7]


def test_shards_leave_the_driver(spark, monkeypatch):
    """Of many shards at most two are held at once."""
    import gc
    import weakref

    alive, most = weakref.WeakSet(), []
    init = decontaminate.Items.__init__

    def counted(self, *args):
        gc.collect()
        alive.add(self)
        most.append(len(alive))
        init(self, *args)

    monkeypatch.setattr(decontaminate.Items, "__init__", counted)
    docs = queries.table(spark, SF, "documents").limit(20)
    out = decontaminate.drop_contaminated(docs, queries.table(spark, SF, "benchmark"), shard=250)
    assert len(most) > 3 and max(most) <= 2 and out.count() <= 20


def test_overlaps_equal_brute_force_on_the_given_tables(spark):
    def norm(text):
        return [w[:-1] if len(w) > 1 and w[-1] in ".,!?;:" else w for w in (text or "").lower().split()]

    runs = {tuple(w[k:k + 14]) for r in queries.table(spark, LARGER, "benchmark").collect()
            for w in [norm(r.text)] for k in range(len(w) - 13)}
    expected = {r.doc_id for r in queries.table(spark, LARGER, "documents").collect()
                for w in [norm(r.text)] if any(tuple(w[k:k + 14]) in runs for k in range(len(w) - 13))}
    assert {r.doc_id for r in queries.op5_decontaminate(spark, LARGER).collect()} == expected


def test_every_pattern_that_agrees_has_a_seed():
    for n in range(decontaminate.LEAST, decontaminate.WINDOW + 1):
        spoiled = n - math.ceil(decontaminate.AGREE * n - 1e-9)
        equal = np.array([[i not in gone for i in range(n)] for gone in itertools.combinations(range(n), spoiled)])
        hit = np.zeros(len(equal), bool)
        for m in decontaminate.MASKS:
            for k in range(n - len(m) + 1):
                hit |= equal[:, [k + i for i, c in enumerate(m) if c == "1"]].all(axis=1)
        assert hit.all(), n


def test_overlaps_equal_a_sliding_comparison_under_random_substitutions():
    rng = np.random.default_rng(2)
    sizes = [5, 6, 8, 10, 14, 17, 20, 27, 40]
    items = [[f"i{k}w{j}" if j % 3 else f"c{j % 7}" for j in range(n)] for k, n in enumerate(sizes)]
    docs = []
    for item in items:
        for rate in (0, .1, .2, .25, .3, .35):
            for _ in range(6):
                copy = [f"s{rng.integers(9)}" if rng.random() < rate else w for w in item]
                docs.append([f"r{rng.integers(50)}" for _ in range(rng.integers(5))] + copy + ["z"] * int(rng.integers(3)))
        for phase in range(4):
            docs.append(["s" if j % 4 == phase else w for j, w in enumerate(item)])

    def overlap(doc, item):
        w = min(len(item), decontaminate.WINDOW)
        for shift in range(1 - len(item), len(doc)):
            equal = [0 <= shift + j < len(doc) and doc[shift + j] == t for j, t in enumerate(item)]
            if any(sum(equal[k:k + w]) >= decontaminate.AGREE * w - 1e-9 for k in range(len(item) - w + 1)):
                return True
        return False

    found = decontaminate.Items(list(range(len(items))), [" ".join(i) for i in items])
    rows_ = found.overlaps(*decontaminate.tokens(pa.array([" ".join(d) for d in docs])))
    expected = {(d, i) for d, doc in enumerate(docs) for i, item in enumerate(items) if overlap(doc, item)}
    assert {(int(r[0]), int(r[1])) for r in rows_} == expected and len(rows_) == len(expected)


# ---- 6: chat formatting
def test_turns_come_back_from_the_formatted_bytes():
    roles = ["user", "assistant", None, "we\nird\\", "", "#", "a\\\n"]
    texts = [r"\### Assistant: </turn> ok", "", None, "é\n\\\\#<<", "</turn>\n### user\n", "\\", "x"]
    turns, first, end = chat.assemble(pa.array(roles, pa.string()), pa.array(texts, pa.string()))
    for role, content, turn, a, b in zip(roles, texts, turns.to_pylist(), first, end):
        raw = turn.encode()
        assert chat.read_turn(raw) == ((role or "").encode(), (content or "").encode())
        assert chat.unescape(raw[a:b]) == (content or "").encode()
        assert raw.count(b"</turn>") == 1 and raw.count(b"### ") == 1


def test_chat_odd_rows(spark):
    given = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "assistant", "é"), (2, 1, "assistant", "b" * 9000)]
    frame = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    found = {r.conv_id: r for r in chat.digests(chat.format_turns(frame)).collect()}
    assert (found[1].n_turns, found[1].loss_chars, found[None].loss_chars, found[2].loss_chars) == (3, 0, 1, 9000)
    assert chat.digests(chat.format_turns(frame.limit(0))).count() == 0


# ---- 8: language ID
def test_languages_of_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in queries.table(spark, LARGER, "documents").select("doc_id", "lang").collect()}
    found = queries.op8_language_id(spark, LARGER).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == len(truth) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_odd_rows(spark, odd_docs, no_docs):
    model = language.fit(odd_docs)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(odd_docs, model).collect()}
    assert all(found[i] == ("und", 0.0) for i in (1, 2, 3, 4)) and found[0][0] in ("en", "de")
    assert sorted(r[0] for r in rows(language.identified(odd_docs, model), "doc_id") if r[0] is not None) == [0, 0, 5, 6, 7]
    none = language.fit(no_docs)
    assert {r.lang_pred for r in language.predict(odd_docs, none).collect()} == {"und"}
    one = language.fit(odd_docs.where("lang = 'en'"))
    assert rows(language.predict(odd_docs.where("doc_id = 6"), one), "lang_pred", "score") == [("en", 1.0)]


def test_language_learns_from_every_row(spark):
    texts = [(i, f"wort{i} und noch eins" if i % 2 else f"word{i} and one more", "de" if i % 2 else "en") for i in range(1000)]

    def weights(changed):
        own = [(i, "zzyx qqvj xxkw" if i == changed else text, lang) for i, text, lang in texts]
        return language.fit(spark.createDataFrame(own, "doc_id long, text string, lang string").coalesce(1)).weights["de", "en"]

    whole = weights(None)
    assert not any(np.array_equal(whole, weights(i)) for i in (3, 250, 501, 760, 999))


def test_language_blocks_hold_every_text_once():
    texts = [f"word{i} " * (i % 7 + 1) for i in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([str(i) for i in range(3000)]), pa.array([i % 5 == 0 for i in range(3000)])],
                                       names=["text", "lang", "held"])
    found = list(language._blocks(iter([batch, batch.slice(0, 0)])))
    assert sorted((held, lang) for held, langs, _ in found for lang in langs) == sorted((i % 5 == 0, str(i)) for i in range(3000) for _ in range(2))
    assert all(len(x.off) == len(langs) + 1 and len(langs) <= 2 * language.BLOCK for _, langs, x in found)


# ---- 9: packing
def _check_pieces(found, expected):
    """expected: doc_id -> list of its ids (several documents of one id: one after the other is not checked)."""
    sequences, at = {}, Counter()
    for r in sorted(found, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(expected[r.doc_id])
        ids = expected[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == Counter({d: len(ids) for d, ids in expected.items()})
    padding = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096
        padding += 4096 - end if end & (end - 1) else 0
    return padding


def test_packing_keeps_every_id_once(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.word_bpe())
    docs = queries.table(spark, SF, "documents").collect()
    encoded = t.encode_batch([d.text or "" for d in docs], add_special_tokens=False)
    expected = {d.doc_id: [*e.ids, 2] for d, e in zip(docs, encoded)}
    assert _check_pieces(queries.op9_packing(spark, SF).collect(), expected) == 0


def test_encoder_equals_the_tokenizer_on_odd_texts():
    enc = packing.encoder(queries.word_bpe())
    texts = ["It's a.b,c!? don't;x", "E\u0301t\u00e9 .'s 12,3", "", "a\u0301.b \u00a0x\u2028y", "<|endoftext|>", "ΑΣ ΑΣ.", "x" * 300, "'.re ,m"]
    ids, off = enc.encode(pa.array(texts))
    for text, a, b in zip(texts, off[:-1], off[1:]):
        assert ids[a:b].tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_matches_added_tokens_on_the_raw_text():
    enc = packing.encoder(queries.word_bpe())
    texts = ["a <|ENDOFTEXT|> b", "<|StartOfText|>", "a <|endoftext|> b", "X<|EndOfText|>Y.", "A.B<|endoftext|>C <|ENDOFTEXT|>."]
    ids, off = enc.encode(pa.array(texts))
    for text, a, b in zip(texts, off[:-1], off[1:]):
        assert ids[a:b].tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_respects_all_three_limits(spark, odd_docs, no_docs):
    prompts = F.when(F.col("doc_id") == 5, 1000).otherwise(0)
    pieces = packing.pack(odd_docs, queries.word_bpe(), tokens=64, segments=3, loss=40, loss_from=prompts).collect()
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
    for own in by.values():
        assert sum(p.length for p in own) <= 64 and len(own) <= 3 and sum(p.loss_tokens for p in own) <= 40
    assert sum(p.length for p in pieces if p.doc_id == 1) == 1
    assert sum(p.length for p in pieces if p.doc_id == 5) == 3001
    assert packing.pack(no_docs, queries.word_bpe()).count() == 0
