import hashlib
import math
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weekloom.llm import mixing, oracle, pieces

from .helpers_llm import awkward, documents, empty, random_texts


# --- mixing -----------------------------------------------------------------------------

def corpus(spark):
    frame = None
    for number, (source, n) in enumerate([("b", 60), ("a", 5), (None, 40), ("é", 30), ("z", 80)]):
        part = documents(spark, random_texts(20 + number, n, (0, 200)), source=source, first=1000 * number)
        frame = part if frame is None else frame.union(part)
    return frame


def resharing(sizes):
    """Targets by repeated resharing, as it is worded."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        share = (left - sum(2.0 * sizes[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if share * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else share * weight[s] for s in order}
        full |= over


@pytest.mark.parametrize("block_words", [7, 64, 1024])
def test_mix_meets_its_targets(spark, block_words):
    docs = corpus(spark)
    rows = mixing.taken(docs, block_words=block_words, shard_slots=16).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) and 0 <= r.taken <= 2 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    wanted = resharing(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in sizes)


def test_reruns_and_sql_agree(spark):
    docs = corpus(spark)
    first = {tuple(r) for r in mixing.taken(docs).collect()}
    assert first == {tuple(r) for r in mixing.taken(docs.repartition(9)).collect()}
    docs.toPandas().to_parquet(path := "/tmp/mixing-llm-test.parquet")
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    assert first == {tuple(r) for r in sql.execute(oracle.MIXING).fetchall()}


def test_pieces_of_the_mix_are_the_words_taken(spark):
    docs = corpus(spark).withColumn("size", F.lit("extra"))
    out = mixing.mixed(docs, block_words=32, shard_slots=8)
    assert out.columns == docs.columns
    words = defaultdict(int)
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        assert r.text.strip() in whole[r.doc_id] and r.n_chars == len(r.text)
        words[r.doc_id] += len(r.text.split())
    assert {r.doc_id: r.taken for r in mixing.taken(docs, block_words=32, shard_slots=8).collect() if r.taken} == dict(words)


def test_slots_of_shards_cover_each_source_once(spark):
    rows = mixing.sized(corpus(spark))
    plans = mixing.plan(mixing.targets(rows), 16)
    drawn = mixing.drawn(plans, 8).collect()
    slots = {r.source_no: r.slots for r in plans.collect()}
    for source, n in slots.items():
        held = sorted((r.lo, r.hi) for r in drawn if r.source_no == source)
        assert [x for lo, hi in held for x in range(lo, hi)] == list(range(n))
    assert len({r.shard for r in drawn}) > 3


def test_plan_has_no_python(spark):
    text = mixing.taken(corpus(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def test_mixing_awkward_tables(spark):
    got = mixing.taken(awkward(spark)).collect()
    assert len(got) == 10 and all(r.taken <= 2 * r["size"] for r in got)
    assert mixing.taken(empty(spark)).count() == 0
    assert {r.target for r in mixing.taken(documents(spark, ["", None, " "])).collect()} == {0.0}
    out = mixing.mixed(awkward(spark))
    assert out.columns == awkward(spark).columns and out.count() > 0
    assert mixing.mixed(empty(spark)).count() == 0


def test_texts_of_one_id_and_size_are_mixed_each(spark):
    texts = [f"{a} {b} end" for a in ("red", "blue", "green") for b in ("one", "two", "three", "four")]
    for doc_id in (None, 7):
        docs = documents(spark, texts * 2).withColumn("doc_id", F.lit(doc_id).cast("long"))
        docs = docs.withColumn("n_chars", F.lit(0).cast("long"))
        words = defaultdict(int)
        for r in mixing.mixed(docs, block_words=5, shard_slots=4).collect():
            for w in r.text.split():
                words[w] += 1
        once = defaultdict(int)
        for w in " ".join(texts * 2).split():
            once[w] += 1
        assert sum(words.values()) == 1.5 * sum(once.values())
        assert all(once[w] <= words[w] <= 2 * once[w] for w in once)


# --- pieces -----------------------------------------------------------------------------

def viterbi(table, word):
    """Ids and score of the best path, ties to the longest last piece."""
    known = {p: (i, s) for p, i, s in table.rows}
    best = [(0.0, -1, None)] + [None] * len(word)
    for stop in range(1, len(word) + 1):
        for start in range(max(0, stop - table.longest), stop):
            part = word[start:stop]
            i, s = known.get(part, (-1 - ord(part), table.unknown) if len(part) == 1 else (None, None))
            if i is not None and (best[stop] is None or best[start][0] + s > best[stop][0]):
                best[stop] = (best[start][0] + s, start, i)
    ids, at = [], len(word)
    while at:
        ids.append(best[at][2])
        at = best[at][1]
    return table.spelled(ids[::-1])


TEXTS = ["", " ", "  two  spaces ", "a\nb\n\nc", "été naïve 日本語 🙂", "the the thththe ster mit sterach", "tab\tand\x00nul", "x" * 700, None]


def test_pieces_equal_a_plain_viterbi(spark):
    texts = TEXTS + random_texts(30, 40)
    table = pieces.pieces()
    rows = pieces.encode(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == [i for w in pieces.words(text) for i in viterbi(table, w)] and r.n_tokens == len(r.ids)
        assert table.decode(r.ids).decode() == text and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(documents(spark, texts))).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}


def test_long_words_are_solved_whole(spark):
    """Pieces that span the 512th character, in words of its length and beyond."""
    table = pieces.pieces()
    texts = ["understandingthestreet" * 30, "x" * 505 + "understanding" * 60, "日本語ster" * 200, "a" * 511, "a" * 512, "short " + "Enheit" * 300]
    for r in pieces.encode(documents(spark, texts)).collect():
        uncut = re.findall("▁[^▁]*", "▁" + texts[r.doc_id].replace(" ", "▁"))
        assert r.ids == [i for w in uncut for i in viterbi(table, w)]
        assert table.decode(r.ids).decode() == texts[r.doc_id]


def test_best_paths_have_the_library_s_score():
    import public_tokenizers
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as formats

    model = formats.ModelProto()
    model.ParseFromString(open(public_tokenizers.path(pieces.MODEL), "rb").read())
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    table = pieces.pieces()
    scores = {i: s for _, i, s in table.rows}
    for word in ("the", "ster", "sterach", "thtionhe", "understanding", "Enheit"):
        best = library.nbest_encode_as_ids(word, 3)[0]
        assert math.fsum(scores[i] for i in best) == math.fsum(scores[i] for i in viterbi(table, pieces.MARK + word))


def test_pieces_of_awkward_tables(spark):
    assert pieces.encode(awkward(spark)).count() == 10
    assert pieces.encode(empty(spark)).count() == 0


# --- pipeline ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    texts = random_texts(40, 300, (30, 60))
    toxic = {i for i in range(300) if i % 10 == 0}
    texts = [t + " nastyword and badword" if i in toxic else t for i, t in enumerate(texts)]
    texts[201], texts[203] = texts[1], texts[3] + " changed"
    texts[5] += " write to jo@ex.org"
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(250)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, texts, toxic


def test_stages_have_their_effect(spark, planted):
    folder, texts, toxic = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert {r.doc_id for r in kept.collect()} == set(range(300)) - toxic
    single = corpus_pipeline.drop_near_copies(spark, kept, folder)
    assert {r.doc_id for r in single.collect()} == set(range(300)) - toxic - {201, 203}
    clean = {r.doc_id: r.text for r in corpus_pipeline.sanitise(spark, single, folder).collect()}
    assert clean[5].endswith("<email>") and all(clean[i] == texts[i] for i in clean if i != 5)
    mix = corpus_pipeline.mix(spark, corpus_pipeline.sanitise(spark, single, folder), folder)
    assert mix.columns == docs.columns
    taken = defaultdict(int)
    for r in mix.collect():
        taken[r.doc_id] += len(r.text.split())
    size = {i: len(t.split()) for i, t in clean.items()}
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= 1 and all(n <= 2 * size[i] for i, n in taken.items())


def test_rows_are_dropped_one_by_one(spark, planted):
    """Null and repeated ids: a decision holds for the rows it was made for."""
    folder, texts, toxic = planted
    first = spark.read.parquet(f"{folder}/documents.parquet")
    more = documents(spark, [texts[10], texts[2] + " end", texts[0], texts[4] + " fine", "quite other words stand in this one text"])
    more = more.withColumn("doc_id", F.element_at(F.array(F.lit(None), F.lit(None), F.lit(7), F.lit(None), F.lit(9)), (F.col("doc_id") + 1).cast("int")).cast("long"))
    kept = corpus_pipeline.drop_toxic(spark, first.union(more), folder)
    clean = [t for i, t in enumerate(texts) if i not in toxic] + [texts[2] + " end", texts[4] + " fine", "quite other words stand in this one text"]
    assert sorted(r.text for r in kept.collect()) == sorted(clean)
    single = corpus_pipeline.drop_near_copies(spark, kept, folder)
    left = [t for i, t in enumerate(texts) if i not in toxic | {201, 203}] + ["quite other words stand in this one text"]
    assert sorted(r.text for r in single.collect()) == sorted(left)


def test_run_applies_all_stages(spark, planted):
    folder, texts, toxic = planted
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} <= set(range(300)) - toxic - {201, 203}
    assert sum(r.n_tokens for r in rows) == sum(len(r.ids) for r in rows) > 0
    decoded = [pieces.pieces().decode(r.ids) for r in rows]
    assert all(hashlib.sha256(d).hexdigest() == r.decoded_sha256 for d, r in zip(decoded, rows))


def test_stages_of_awkward_and_empty_tables(spark, planted):
    folder = planted[0]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (awkward(spark).select(*columns), empty(spark), awkward(spark)):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 0
