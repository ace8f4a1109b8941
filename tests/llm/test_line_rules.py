"""Line-first cleaning against a plain form, and the cases its docstring states."""

import random
import re
from collections import Counter

from weekloom.llm import line_rules
from tests.llm.helpers_llm import awkward, documents, empty, random_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, by counting."""
    text = text or ""
    words = WORD.findall(text)
    grams = list(zip(words, words[1:], words[2:]))
    often = Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if often[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def messy_texts(seed, n):
    draw = random.Random(seed)
    extra = ["", "a | b | c | d", "Home > News > Sport > More", "BUY!! NOW!! HERE!!", "All rights reserved.", "menu", "été déjà vu 🙂 «oui».", "x y z.", "a\tb\x0bc\r"]
    out = []
    for text in random_texts(seed, n, (0, 120), 40):
        words = text.split(" ")
        lines = [" ".join(words[i : i + 9]) + draw.choice([".", "", "!"]) for i in range(0, len(words), 9)]
        lines += draw.choices(extra + lines[:2], k=draw.randint(0, 6))
        draw.shuffle(lines)
        out.append("\n".join(lines))
    return out


def test_measures_equal_a_plain_count(spark):
    texts = messy_texts(5, 150) + [None, "", " \n ", "one two three one two three", "a a a a", "a b a b a"]
    found = {r.doc_id: r for r in line_rules.cleaned(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_lines_that_fail_are_removed_and_named(spark):
    prose = "the quick brown fox jumps over a lazy dog near the old stone bridge today."
    text = "\n".join(["Home | News | Sport | More", prose, "WIN!! BIG!! MONEY!!", "Menu", "", prose, "Copyright 2020 by us, the authors of this page."])
    r = line_rules.cleaned(documents(spark, [text])).first()
    assert r.faults == ["navigation", "punctuation", "punctuation", "boilerplate", "boilerplate"]
    assert r.clean_text == prose + "\n"
    assert r.lost_chars == sum(len(w) for line in text.split("\n")[:1] + text.split("\n")[2:4] + text.split("\n")[5:] for w in line.split())


def test_documents_that_lose_too_much_are_rejected(spark):
    good = [" ".join(f"word{i}x{j}" for j in range(20)) + "." for i in range(4)]
    menu = " | ".join(f"entry{i}" for i in range(200))
    found = line_rules.cleaned(documents(spark, ["\n".join(good), "\n".join([*good, menu]), menu]))
    assert [(r.base_failed, r.kept) for r in found.orderBy("doc_id").collect()] == [(False, True), (False, False), (False, False)]
    assert line_rules.cleaned(documents(spark, ["\n".join([*good, menu])]), most_lost=0.9).first().kept


def test_words_are_whole_across_stretches(monkeypatch):
    data = " ".join(random_texts(3, 30)).encode()
    whole = line_rules.hashed_words(data)
    monkeypatch.setattr(line_rules, "_STRETCH", 7)
    assert (line_rules.hashed_words(data) == whole).all() and len(whole) == len(data.split())


def test_awkward_and_empty_tables(spark):
    rows = line_rules.cleaned(awkward(spark)).collect()
    assert len(rows) == 10 and sum(r.doc_id is None for r in rows) == 1
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_words == 0 and by_id[1].base_failed and not by_id[1].kept and by_id[1].clean_text == ""
    assert by_id[6].n_words == 30_000 and by_id[6].n_repeat_words == 30_000 and not by_id[6].kept
    assert by_id[7].n_words == 1 and by_id[7].word_chars == 3_000
    assert line_rules.cleaned(empty(spark)).count() == 0
