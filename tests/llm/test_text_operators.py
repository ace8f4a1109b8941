import hashlib
import math
import pickle
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weekloom.llm import language, privacy, toxicity, winnow

from .helpers_llm import awkward, documents, empty, random_texts


# --- fingerprints -----------------------------------------------------------------------

def plain_winnowing(text, k, w):
    if not text:
        return []
    k = min(k, len(text))
    hashes = [int(winnow.gram_hashes(winnow.code_points(text[i : i + k]), k)[0]) for i in range(len(text) - k + 1)]
    w = min(w, len(hashes))
    kept = set()
    for i in range(len(hashes) - w + 1):
        least = min(hashes[i : i + w])
        kept.add((max(j for j in range(i, i + w) if hashes[j] == least), least))
    return sorted(kept)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab c", max_size=120), st.integers(1, 8), st.integers(1, 9))
def test_winnowing_equals_its_plain_form(text, k, w):
    hashes, places = winnow.fingerprint(text, k, w)
    assert list(zip(places.tolist(), hashes.tolist())) == plain_winnowing(text, k, w)


def test_stretches_join_without_a_seam(monkeypatch):
    text = " ".join(random_texts(3, 30))
    whole = [x.tolist() for x in winnow.fingerprint(text)]
    monkeypatch.setattr(winnow, "_STRETCH", 97)
    assert [x.tolist() for x in winnow.fingerprint(text)] == whole


def test_shared_run_is_matched():
    shared = "exactly these forty-nine characters are in both of them"[: winnow.GRAM + winnow.WINDOW - 1]
    a, b = (set(winnow.fingerprint(x)[0].tolist()) for x in ("one " * 30 + shared + " tail", "another start " + shared + "!" * 50))
    assert a & b


def test_edits_follow_the_order_of_ids(spark):
    texts = random_texts(4, 57) + ["", None, "é🙂" * 40]
    got = {r.doc_id: r for r in winnow.edits(documents(spark, texts).repartition(7)).collect()}
    for i, text in enumerate(texts):
        text, following = text or "", texts[i - 1] or ""
        edited = winnow.edited_text(text, following)
        mine, theirs, after = (winnow.fingerprint(t) for t in (text, edited, following))
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (winnow.encoded(mine), winnow.encoded(theirs))
        sets = [set(x[0].tolist()) for x in (mine, theirs, after)]
        for likeness, other in ((row.near_edited, sets[1]), (row.near_next, sets[2])):
            total = len(sets[0]) + len(other)
            assert likeness == pytest.approx(2 * len(sets[0] & other) / total if total else 1.0)


def test_fingerprints_of_awkward_tables(spark):
    assert winnow.edits(awkward(spark)).count() == 10
    assert winnow.edits(empty(spark)).count() == 0
    single = winnow.edits(documents(spark, ["only one text"])).collect()
    assert len(single) == 1
    assert winnow.fingerprints(awkward(spark)).count() == 10


# --- personal data ----------------------------------------------------------------------

def plain_spans(text):
    """The stated patterns as they are."""
    def passes(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and passes(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("0123456789.-+@ ()ab%_é"), max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert privacy.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("text", [
    "4111 1111 1111 1111", "4111-1111 1111--1111", "x" * 5000 + "@b.co", "1" * 30_000, "a@b.c@d.e x@y", "1.2.3.4", "+1.2.3.4.5.6.7.8.9",
    "01.002.0003.4 999.1.1.1 1.1.1.256", "mail me: a.b+c%d@sub-domain.example.org, or +49 (170) 123-4567.",
])
def test_base_spans_of_chosen_texts(text):
    assert privacy.base_spans(text) == plain_spans(text)


def test_terms_that_disclose_a_value(spark):
    draw = random_texts(5, 60, (6, 12))
    texts = [f"{draw[i]} kestrel jo@ex.org the {draw[i + 20]}" for i in range(4)] + [f"the {t}" for t in draw[20:]]
    got = {r.doc_id: r for r in privacy.spans_of(documents(spark, texts)).collect()}
    for i in range(4):
        at = texts[i].index("kestrel")
        assert got[i].n_email == 1 and f"term:{at}:{at + 7}" in got[i].spans
        the = texts[i].index(" the ") + 1
        assert f"term:{the}:" not in got[i].spans
        base = privacy.joined(plain_spans(texts[i]))
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and got[i].spans.startswith(base)
    assert all(got[i].spans == "" for i in range(4, len(texts)))
    clean = {r.doc_id: r.text for r in privacy.sanitised(documents(spark, texts)).collect()}
    assert all("<term> <email> the" in clean[i] and "kestrel" not in clean[i] for i in range(4))
    assert all(clean[i] == texts[i] for i in range(4, len(texts)))


def test_words_far_from_a_value_disclose_it_everywhere_in_the_text(spark):
    draw = random_texts(15, 80, (30, 40))
    texts = [f"Kestrel {draw[i]} {draw[i + 20]} jo@ex.org {draw[i + 40]} kestrel." for i in range(4)] + draw[20:]
    got = {r.doc_id: r for r in privacy.spans_of(documents(spark, texts)).collect()}
    for i in range(4):
        at = texts[i].index("kestrel")
        assert "term:0:7" in got[i].spans.split(",") and f"term:{at}:{at + 7}" in got[i].spans.split(",")
    assert all(got[i].spans == "" for i in range(4, len(texts)))
    clean = {r.doc_id: r.text for r in privacy.sanitised(documents(spark, texts)).collect()}
    assert all("kestrel" not in clean[i].lower() for i in range(4))


@pytest.mark.parametrize("also", [[], [f"mail kestrel@site{i}.org now" for i in range(8)]])
def test_words_inside_values_count_for_nothing(spark, also):
    draw = random_texts(25, 60, (6, 12))
    texts = [f"{draw[i]} kestrel jo@ex.org the {draw[i + 20]}" for i in range(4)] + [f"the {t}" for t in draw[20:]] + also
    got = {r.doc_id: r for r in privacy.spans_of(documents(spark, texts)).collect()}
    for i in range(4):
        at = texts[i].index("kestrel")
        assert f"term:{at}:{at + 7}" in got[i].spans


def plain_terms(texts, support=3, disclosure=0.9):
    """Every place of a disclosing word, by text, from all pairs of words and values."""
    different = sorted(set(texts))
    spans = {t: privacy.base_spans(t) for t in different}
    words = {t: {w for w, _, _ in privacy.outside(t, spans[t])} for t in different}
    around = {t: " ".join(w for w, _, _ in privacy.outside(t, spans[t])) for t in different}
    held = {t: {privacy.entity(k, t[a:b]) for k, a, b in spans[t]} for t in different}
    rows = Counter(texts)
    n = Counter(w for t in texts for w in words[t])
    told = {t: set() for t in different}
    for e in set().union(*held.values()):
        holders = [t for t in different if e in held[t]]
        of_entity = sum(rows[t] for t in holders)
        if of_entity == len(texts):
            continue
        for w in set().union(*(words[t] for t in holders)):
            meet = [t for t in holders if w in words[t]]
            mutual = math.log2(sum(rows[t] for t in meet) * len(texts) / of_entity / n[w])
            if len({around[t] for t in meet}) >= support and mutual >= disclosure * math.log2(len(texts) / of_entity) - 1e-12:
                for t in meet:
                    told[t].add(w)
    return {t: [("term", a, b) for w, a, b in privacy.outside(t, spans[t]) if w in told[t]] for t in different}


def test_added_spans_equal_all_pairs(spark):
    draw, pick = random_texts(35, 400, (5, 9), 60), random.Random(35)
    values = ["jo@ex.org", "al@ex.org", "1.2.3.4", "+49 170 1234567"]
    birds = ["osprey", "heron", "wren", "stork"]
    texts = [f"{t} {birds[i % 4]} {values[i % 4]} {pick.choice(values)} {t[:3]}" if i < 60 else t for i, t in enumerate(draw)]
    texts += texts[:5] + [f"signed {t} jo@ex.org al@ex.org bee@ex.org" for t in draw[100:104]] + ["wren@ex.org", "", "heron alone"]
    want = plain_terms(texts)
    assert sum(map(len, want.values())) > 20
    for r in privacy.spans_of(documents(spark, texts)).collect():
        assert r.spans == privacy.joined([*plain_spans(texts[r.doc_id]), *want[texts[r.doc_id]]])


def test_words_outside_values():
    text = "Ab jo@ex.org cd +49 170 1234567 Ef"
    assert privacy.outside(text, privacy.base_spans(text)) == [("ab", 0, 2), ("cd", 13, 15), ("ef", 32, 34)]


def test_copies_of_one_surrounding_back_nothing(spark):
    texts = ["rare words stand by jo@ex.org in this copy"] * 6 + random_texts(6, 20, (6, 12))
    assert all("term" not in r.spans for r in privacy.spans_of(documents(spark, texts)).collect())


def test_overlapping_spans_are_replaced_once():
    assert privacy.redacted("call +1 4111111111111111 now", [("phone", 5, 24), ("card", 8, 24)]) == "call <phone> now"


def test_personal_data_of_awkward_tables(spark):
    assert privacy.spans_of(awkward(spark)).count() == 10
    assert privacy.spans_of(empty(spark)).count() == 0
    out = privacy.sanitised(awkward(spark))
    assert out.columns == awkward(spark).columns and out.count() == 10
    assert out.where("text IS NULL").count() == 1


# --- toxicity ---------------------------------------------------------------------------

def labelled_documents(spark):
    texts = random_texts(7, 300, (20, 60))
    marks = [(i, 0, int(i % 6 == 0)) for i in range(240)]
    texts = [t + " nastyword you badword" if i % 6 == 0 else t for i, t in enumerate(texts)]
    return documents(spark, texts), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxic_texts_are_told_from_clean_ones(spark):
    docs, labels = labelled_documents(spark)
    rows = toxicity.score(docs, labels).collect()
    for row in rows:
        assert 0 <= row.score <= 1 and len(row.evidence) == 3
        assert row.predicted == int(row.doc_id % 6 == 0) == int(row.score >= toxicity.THRESHOLD)
        assert all(e.toxic == 1 for e in row.evidence) if row.predicted else any(e.toxic == 0 for e in row.evidence)
    assert len({r.score for r in rows}) > 20


def test_rare_and_common_telling_words_are_kept(spark):
    """A word in 1.7% of the toxic texts, and one that more clean than toxic texts hold."""
    draw = random_texts(17, 2100, (3, 6))
    texts = [f"{t} spread" + " seldom" * (i < 5) if i < 300 else t + " spread" * (i % 5 == 0) for i, t in enumerate(draw)] + ["seldom heard"]
    docs = documents(spark, texts)
    marks = spark.createDataFrame([(i, 0, int(i < 300)) for i in range(2100)], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, marks).where("doc_id = 2100").first()
    assert [e.doc_id < 5 and e.toxic == 1 for e in got.evidence] == [True] * 3 and toxicity.EXAMPLES == 20_000


def plain_scores(texts, toxic, neighbours):
    """(score, nearest three) of every text, its examples all labelled texts; dense vectors over every word."""
    import numpy as np

    held = [Counter(re.findall(r"[^\W\d_]+", (t or "").lower())) for t in texts]
    examples = {}
    for i, y in toxic.items():
        examples.setdefault(texts[i] or "", [i, y])
    examples = sorted(examples.values())
    words = sorted(set().union(*(held[i] for i, _ in examples)))
    marks = np.array([y for _, y in examples])
    counts = np.array([[h[w] for w in words] for h in held], float).reshape(len(held), len(words))
    own = counts[[i for i, _ in examples]]
    part = marks.mean()
    t = ((own[marks == 1] > 0).sum(0) + 8 * part) / (marks == 1).sum()
    c = ((own[marks == 0] > 0).sum(0) + 8 * (1 - part)) / (marks == 0).sum()
    idf = (np.log((1 + len(held)) / (1 + (counts > 0).sum(0))) + 1) * np.maximum(0.05, (t - c) / (t + c))
    dense = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    dense /= np.maximum(1e-300, np.sqrt((dense**2).sum(1, keepdims=True)))

    def vote(row, without=None):
        cosines = dense[[i for i, _ in examples]] @ row
        order = [e for e in np.argsort(-cosines, kind="stable") if cosines[e] > 1e-15 and e != without][:neighbours]
        weights = np.array([1 / (0.05 + max(0, 1 - cosines[e])) for e in order])
        return (weights * marks[order]).sum() / weights.sum() if order else None, [cosines[e] for e in order[:3]]

    votes = [(vote(dense[i], n)[0], y) for n, (i, y) in enumerate(examples)]
    votes = [(v, y) for v, y in votes if v is not None]
    prior = marks.sum() / (len(marks) + 1)
    pools = []
    for tenth in range(10):
        inside = [y for v, y in votes if min(9, int(v * 10)) == tenth]
        pools.append([sum(inside) + ((tenth + 0.5) / 10 + prior) / 2, len(inside) + 1, 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] > pools[-1][0] / pools[-1][1]:
            pools[-2:] = [[x + y for x, y in zip(*pools[-2:])]]
    shares = [h / m for h, m, n in pools for _ in range(n)]
    out = []
    for row in dense:
        v, near = vote(row)
        out.append((prior if v is None else min(1.0, np.interp(v, (np.arange(10) + 0.5) / 10, shares)), near))
    return out


def test_scores_equal_a_plain_search_over_all_words(spark):
    docs, labels = labelled_documents(spark)
    more = [None, "", "unheardof", "nastyword", "clean nastyword"]
    rows = sorted(docs.union(documents(spark, more, first=300)).collect(), key=lambda r: r.doc_id)
    want = plain_scores([r.text for r in rows], {r.doc_id: r.toxic for r in labels.collect()}, toxicity.NEIGHBOURS)
    got = {r.doc_id: r for r in toxicity.score(docs.union(documents(spark, more, first=300)), labels).collect()}
    for i, (likely, near) in enumerate(want):
        assert [e.cosine for e in got[i].evidence] == pytest.approx(near, abs=1e-9)
        assert got[i].score == pytest.approx(likely, abs=1e-6)


@pytest.mark.parametrize("share", [1 / 8, 1 / 12, 0.0, 1.0])
def test_index_finds_the_exact_nearest(share):
    import numpy as np

    draw = np.random.default_rng(1)
    idf = draw.uniform(0.5, 3, 40)
    examples = []
    for i in range(700):
        terms = sorted(draw.choice(40, draw.integers(1, 6), replace=False).tolist())
        examples.append((i, int(draw.integers(2)), terms, draw.integers(1, 4, len(terms)).tolist()))
    index = pickle.loads(pickle.dumps(toxicity.Index(idf, examples, block=16, common=share)))
    dense = np.zeros((700, 40))
    for i, (_, _, terms, counts) in enumerate(examples):
        dense[i, terms] = index.unit(terms, counts)
    for i in range(0, 700, 50):
        _, _, terms, counts = examples[i]
        numbers, cosines = index.nearest(terms, counts, 10)
        exact = dense @ dense[i]
        order = np.lexsort((np.arange(700), -exact.round(12)))
        order = [o for o in order if exact[o] > 0][:10]
        assert numbers.tolist() == order and np.allclose(cosines, exact[order])
        assert i not in index.nearest(terms, counts, 10, without=i)[0]


def two_languages(n):
    """Examples of two languages in turn: ten common words each, and rare words of their own."""
    import numpy as np

    draw, out = np.random.default_rng(3), []
    for i in range(n):
        common = i % 2 * 10 + np.flatnonzero(draw.random(10) < 0.8)
        terms = np.concatenate([common, 20 + np.sort(draw.choice(5000, 12, replace=False))])
        out.append((i, int(draw.integers(2)), terms, draw.integers(1, 3, len(terms))))
    return draw.uniform(0.5, 1, 5020), out


def test_blocks_hold_like_examples():
    idf, examples = two_languages(600)
    group = toxicity.like(examples, idf, 300)
    assert {len({group[i] for i in range(p, 600, 2)}) for p in (0, 1)} == {1} and group[0] != group[1]


def test_common_words_of_far_blocks_are_not_read(monkeypatch):
    """A text's own block is multiplied out; of the other one only the lists of rare words are read."""
    idf, examples = two_languages(600)
    index, read = pickle.loads(pickle.dumps(toxicity.Index(idf, examples, block=300))), []
    lists = toxicity.Index.read
    monkeypatch.setattr(toxicity.Index, "read", lambda self, lows, highs, asked: read.append((highs - lows).sum()) or lists(self, lows, highs, asked))
    for _, _, terms, counts in examples[:50]:
        read.clear()
        numbers, _ = index.nearest(terms, counts, 5)
        assert len(numbers) == 5 and sum(read) < 100


def test_words_are_runs_of_letters_whatever_their_place():
    texts = ["", "1 2 _", "Ab ab_aB9b", "İ ß ΑΣ ΑΣΑ _a1b٣c", "²x ½ Ⅷ\n\U0001d4d0 été", " ".join(random_texts(5, 40))]
    known = {}
    for text in texts:
        plain = Counter(re.findall(r"[^\W\d_]+", text.lower()))
        hashes, counts = toxicity.hashed("?! " + text)
        for word, n in plain.items():
            known.setdefault(word, int(toxicity.hashed(word)[0][0]))
        assert dict(zip(hashes.tolist(), counts.tolist())) == {known[w]: n for w, n in plain.items()}
    assert len(set(known.values())) == len(known)


def test_a_task_multiplies_on_one_thread(spark):
    import os

    from weekloom.llm.common import map_batches

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.environ.get("OPENBLAS_NUM_THREADS")] * len(batch))], names=["n"])

    assert {r.n for r in map_batches(spark.range(3), work, "n string").collect()} == {"1"}


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = labelled_documents(spark)
    none = labels.where("toxic > 1")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(empty(spark), labels).count() == 0
    assert toxicity.score(awkward(spark), labels.withColumn("text", F.lit("x"))).count() == 10


# --- language ---------------------------------------------------------------------------

def test_languages_are_told_apart_and_calibrated(spark):
    a, b = random_texts(8, 150, (5, 40)), [t.translate(str.maketrans("abcdefg", "uvwxyzé")) for t in random_texts(9, 150, (5, 40))]
    docs = documents(spark, a, lang="aa").union(documents(spark, b, lang="bb", first=1000))
    model = language.fit(docs, F.col("doc_id") % 5 != 0)
    rows = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 5 = 0").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and (abs(model.weights) < 1e-12).mean() > 0.5


def test_language_of_awkward_tables(spark):
    model = language.fit(awkward(spark), F.lit(True))
    got = {(r.doc_id, r.lang_pred, r.score) for r in language.predict(awkward(spark), model).collect() if r.doc_id in (1, 2, 3)}
    assert got == {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)}
    nothing = language.fit(empty(spark), F.lit(True))
    assert {r.lang_pred for r in language.predict(awkward(spark), nothing).collect()} == {"und"}
    assert language.predict(empty(spark), model).count() == 0


def test_case_and_marks_don_t_matter():
    assert [x.tolist() for x in language.gram_counts("Ab, cd!")] == [x.tolist() for x in language.gram_counts("ab  CD")]
