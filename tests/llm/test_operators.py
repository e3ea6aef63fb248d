"""Every training-data operator against a brute-force version on small fixtures:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import pytest

import corpus_pipeline
from cardwatch.llm import bpe as bpe_module
from cardwatch.llm import linededup, neardup, substrings, warc
from cardwatch.llm.bpe import Automaton, default_vocabulary, encode_decode
from cardwatch.llm.components import components
from cardwatch.llm.decontaminate import contaminated, decontaminate, question_and_answer
from cardwatch.llm.licenses import BASE_PHRASES, TEMPLATES, licence_scan
from cardwatch.llm.linededup import line_dedup
from cardwatch.llm.neardup import near_duplicates
from cardwatch.llm.repetition import quality_rules
from cardwatch.llm.substrings import remove_repeats
from cardwatch.llm.tokencounts import token_counts
from cardwatch.llm.toxicity import sample
from cardwatch.llm.warc import LoserTree, archive_round_trip

SPACE_WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, score double, kept boolean, n_words long, chunk long, bucket int"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def texts_fixture():
    """Random prose with copies, near copies, shared passages, junk, edge cases."""
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(60)] + ["é", "日本", "The", "the", "#x", "a b"]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage = say(60)
    texts = [None, "", " \n\t ", "one", "Two words", "two WORDS", "x" * 5000, ("ab " * 3000).strip()]
    for _ in range(25):
        t = say(rnd.randint(5, 120))
        texts.append(t)
        if rnd.random() < 0.4:
            texts.append(t)
        if rnd.random() < 0.4:
            w = t.split(" ")
            w[rnd.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        if rnd.random() < 0.3:
            texts.append(say(20) + " " + passage + "\n" + say(9))
    texts.append("\n".join([passage, passage, say(4), passage]))
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 0.5, True, 7, 3, 1) for i, t in enumerate(texts_fixture())]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def plain():
    return dict(enumerate(texts_fixture()))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_rules(docs, plain, spark):
    got = by_id(quality_rules(docs))
    assert set(got) == set(plain)
    for i, t in plain.items():
        t = t or ""
        w = SPACE_WORD.findall(t)
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        count, inside = collections.Counter(grams), set()
        for k, g in enumerate(grams):
            if count[g] > 1:
                inside.update(range(k, k + 5))
        seen, dup = set(), 0
        for line in t.split("\n"):
            if SPACE_WORD.search(line):
                dup += line in seen
                seen.add(line)
        r = got[i]
        failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
        want = (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), dup, len(inside), failed)
        assert want == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed), i
        assert not (failed and r.kept)
    assert quality_rules(docs.limit(0)).count() == 0


def test_substring_dedup(docs, plain):
    got = by_id(remove_repeats(docs, with_text=True))
    words = {i: SPACE_WORD.findall(t or "") for i, t in plain.items()}
    n = substrings.WINDOW
    count = collections.Counter(tuple(w[k : k + n]) for w in words.values() for k in range(len(w) - n + 1))
    assert any(c > 1 for c in count.values())
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - n + 1):
            if count[tuple(w[k : k + n])] > 1:
                gone.update(range(k, k + n))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        r = got[i]
        assert (len(w), len(gone), sha(kept), kept) == (r.n_words, r.n_removed, r.kept_sha256, r.kept), i
    assert remove_repeats(docs.limit(0)).count() == 0


def test_chunks_are_cut_by_bytes(spark, monkeypatch, docs, plain):
    """No group holds more than its bytes, or one text; the result does not depend on the cuts."""
    whole = {r.doc_id: r.kept_sha256 for r in remove_repeats(docs).collect()}
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 700)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 1000)
    sizes = substrings._chunked(docs, 4).selectExpr("chunk", "coalesce(octet_length(text), 0) AS n").groupBy("chunk").agg({"n": "sum", "chunk": "count"}).collect()
    assert all(r["sum(n)"] <= 700 or r["count(chunk)"] == 1 for r in sizes) and len(sizes) > 20
    assert {r.doc_id: r.kept_sha256 for r in remove_repeats(docs).collect()} == whole


def brute_components(plain, words, percent):
    sets = {}
    for i, t in plain.items():
        w = SPACE_WORD.findall(lower(t or ""))
        grams = [tuple(w[k : k + words]) for k in range(len(w) - words + 1)] or ([tuple(w)] if w else [])
        sets[i] = set(grams)
    label = {i: i for i in plain}
    changed = True
    pairs = [(a, b) for a in plain for b in plain if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) > 0]
    while changed:
        changed = False
        for a, b in pairs:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return sets, label


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, plain, words, percent):
    sets, label = brute_components(plain, words, percent)
    assert len(set(label.values())) < len(label)
    for i, r in by_id(near_duplicates(docs, words, percent)).items():
        assert (len(sets[i]), label[i], label[i] == i) == (r.n_shingles, r.component_id, r.kept), i


def test_near_duplicates_in_a_large_group(spark):
    """Near copies of one text whose copies are not all linked to each other, among others that share a passage."""
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    plain = {}
    for i in range(120):
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = f"n{rnd.randrange(10**6)}"
        plain[i] = " ".join(w)
    for i in range(120, 160):
        plain[i] = " ".join(base[:30] + [f"m{rnd.randrange(10**6)}" for _ in range(40)])
    _, label = brute_components(plain, 3, 85)
    got = by_id(near_duplicates(spark.createDataFrame(list(plain.items()), "doc_id long, text string"), 3, 85))
    assert {i: r.component_id for i, r in got.items()} == label
    assert 1 < len(set(label.values())) < 160


def list_of(spark, sets):
    """One inverted list that holds all these sets, each its own component: what _rest_pairs takes."""
    import numpy as np
    import pandas as pd

    flat = np.concatenate([np.array(sorted(s), dtype=np.uint64) for s in sets])
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    bits = dict(zip(neardup.PARITY, neardup.parity(flat, first), strict=True))
    ids = np.arange(len(sets))
    mixed = pd.DataFrame({"value": 1, "id": ids, "n": np.diff(first), "component": ids, "largest": 0, **bits})
    full = pd.DataFrame({"doc_id": ids, "shingles": [sorted(s) for s in sets], **bits})
    longs = ", ".join(f"{p} long" for p in neardup.PARITY)
    return (
        spark.createDataFrame(mixed, f"value long, id long, n long, component long, largest long, {longs}"),
        spark.createDataFrame(full, f"doc_id long, shingles array<long>, {longs}"),
        spark.createDataFrame([], "a long, b long"),
    )


@pytest.mark.parametrize("few", [0, 10**6])
@pytest.mark.parametrize("percent", [60, 85])
def test_members_that_stayed_apart_all_meet(spark, monkeypatch, few, percent):
    """Both ways of pairing find every pair of a list that reaches the similarity."""
    monkeypatch.setattr(neardup, "FEW_APART", few)
    rnd = random.Random(percent)
    shared = [rnd.sample(range(1, 2**62), 12) for _ in range(6)]
    sets = []
    while len(sets) < 240:
        if sets and rnd.random() < 0.5:  # an edit of an earlier one, often near the threshold
            s = set(rnd.choice(sets))
            for x in rnd.sample(sorted(s), max(1, len(s) * rnd.randrange(1, 25) // 100)):
                s.remove(x)
                s |= {rnd.randrange(1, 2**62) for _ in range(rnd.randrange(2))}
        else:
            s = {x for c in rnd.sample(shared, rnd.randrange(3)) for x in c} | {rnd.randrange(1, 2**62) for _ in range(rnd.randrange(1, 30))}
        if s:
            sets.append(s)
    mixed, full, none = list_of(spark, sets)
    got = neardup._verified(neardup._rest_pairs(mixed, none, full, percent), full, percent)
    want = {(a, b) for a in range(240) for b in range(a + 1, 240) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    assert len(want) > 50
    assert sorted((r.a, r.b) for r in got.collect()) == sorted(want)


def test_a_long_list_of_unlike_members_is_not_paired_off(spark):
    """20,000 members that share a passage: only the planted near copies are compared."""
    rnd = random.Random(3)
    passage = rnd.sample(range(1, 2**62), 6)
    sets = [passage + rnd.sample(range(1, 2**62), 14) for _ in range(20000)]
    planted = [(k, 19999 - k) for k in range(40)]
    for a, b in planted:
        sets[b] = sets[a][:-1] + sets[b][-1:]
    mixed, full, none = list_of(spark, sets)
    assert neardup._met_by_rarest(mixed, full, 85).count() <= 20 * len(planted)
    assert sorted((r.a, r.b) for r in neardup._rest_pairs(mixed, none, full, 85).collect()) == planted


def test_near_duplicates_edges(spark):
    df = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "A B c d"), (3, None), (4, "")], "doc_id long, text string")
    rows = sorted(map(tuple, near_duplicates(df, 3, 85).collect()), key=str)
    assert rows == sorted([(None, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True)], key=str)
    assert near_duplicates(df.limit(0)).count() == 0
    assert neardup.shared_at_least(10, 100) == 10


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def brute_lines(plain, min_words):
    """Texts without the later copies of runs of any number of lines."""
    lines = {i: [x for x in (plain[i] or "").split("\n") if SPACE_WORD.search(x)] for i in sorted(plain)}
    runs = [(i, p, h) for i, ls in lines.items() for p in range(len(ls)) for h in range(1, len(ls) - p + 1)]
    first, gone, held = {}, collections.defaultdict(set), collections.defaultdict(set)
    for i, p, h in runs:
        held[tuple(lines[i][p : p + h])].add(i)
    for i, p, h in runs:
        run = tuple(lines[i][p : p + h])
        words = sum(len(SPACE_WORD.findall(x)) for x in run)
        shared = words >= linededup.SHARED_WORDS and len(held[run]) >= linededup.SHARED_DOCS
        if first.setdefault(run, (i, p)) < (i, p) and (words >= min_words or shared):
            gone[i].update(range(p, p + h))
    out = {}
    for i, text in plain.items():
        k, left = -1, []
        for x in (text or "").split("\n"):
            k += bool(SPACE_WORD.search(x))
            if not (SPACE_WORD.search(x) and k in gone[i]):
                left.append(x)
        out[i] = (len(lines[i]), len(gone[i]), "\n".join(left))
    return out


@pytest.mark.parametrize("min_words", [20, 7, 5, 1])
def test_line_dedup(spark, plain, min_words):
    rnd = random.Random(11)
    short = ["a b c", "d e", "f", "", "  ", "g h i j k l", "m n", "o " * 30]
    plain = {i: t for i, t in plain.items() if i < 30}
    for _ in range(25):
        plain[len(plain)] = "\n".join(rnd.choice(short) for _ in range(rnd.randint(0, 30)))
    # three lines of nine words, twice: repeated as a run only
    run = "\n".join(f"{k} r s t u v w x y" for k in "abc")
    plain[len(plain)], plain[len(plain) + 1] = f"first\n{run}\nend", f"{run}\nother"
    plain = {i: plain.get(i) for i in range(max(plain) + 1)}
    df = spark.createDataFrame([(i, t, "s", 9) for i, t in plain.items()], "doc_id long, text string, source string, n_lines long").repartition(3)
    got = by_id(line_dedup(df, min_words))
    for i, (n, removed, text) in brute_lines(plain, min_words).items():
        r = got[i]
        assert (n, removed, sha(text), r.source) == (r.n_lines, r.n_removed, r.text_sha256, "s"), i
        assert r.text == (None if plain[i] is None else text)
    assert got[max(plain)].n_removed >= 3
    odd = spark.createDataFrame([(None, "x y\nx y"), (1, "a b\nc"), (1, "a b\nc")], "doc_id long, text string")
    assert sorted(r.n_removed for r in line_dedup(odd, 2).collect()) == [0, 0, 0]
    assert line_dedup(odd.limit(0)).count() == 0


def test_line_dedup_with_a_hot_line(spark, monkeypatch):
    """One line in every document, and a hot run in a third of them: the same whatever counts as hot."""
    rnd = random.Random(12)
    plain = {i: "\n".join(["common line of boilerplate words here", f"own {i} {rnd.random()}", *(["x " * 12, "y " * 12] if i % 3 == 0 else [])]) for i in range(90)}
    df = spark.createDataFrame(list(plain.items()), "doc_id long, text string").repartition(4)
    want = {i: (n, removed, sha(text)) for i, (n, removed, text) in brute_lines(plain, 20).items()}
    for share in (2, 2000):
        monkeypatch.setattr(linededup, "HOT_SHARE", share)
        assert {r.doc_id: (r.n_lines, r.n_removed, r.text_sha256) for r in line_dedup(df).collect()} == want
    assert sum(removed for _, removed, _ in want.values()) == 89 + 2 * 29


@pytest.mark.parametrize("sizes", [[9, 9, 9], [44, 3, 3], [1] * 31])
def test_pipeline_deletes_whole_runs(spark, sizes):
    run = "\n".join(" ".join(f"r{k}w{j}" for j in range(n)) for k, n in enumerate(sizes))
    df = spark.createDataFrame([(1, f"one\n{run}"), (2, f"two\n{run}\nend")], "doc_id long, text string")
    assert by_id(corpus_pipeline.lines(spark, df, ""))[2].text == "two\nend"


def test_pipeline_deletes_short_lines_that_many_documents_share(spark):
    n = linededup.SHARED_DOCS
    texts = {i: f"own {i}\nread more on our own page\n\nthree words, then\ntwo more" for i in range(n)}
    texts |= {n + i: f"other {i}\nstands in too few documents\nLes." for i in range(n - 1)}
    texts[100] = "\n".join(f"stands often in one document\nline {i}" for i in range(n))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = by_id(corpus_pipeline.lines(spark, df, ""))
    assert got[0].text == texts[0] and {got[i].text for i in range(1, n)} == {f"own {i}\n" for i in range(1, n)}
    assert all(got[i].text == texts[i] for i in texts if i >= n)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_vocabulary())


def awkward_texts():
    rnd = random.Random(2)
    pool = [chr(c) for c in [*range(1, 0x250), *range(0x370, 0x700), *range(0x2000, 0x2070), *range(0x3000, 0x3100), *range(0x1F600, 0x1F640), 0x1C89, 0xA7CB]]
    out = ["it's we'll 'tis  don't\n\n  x 's ''s I'dx they'reX", "a<|endoftext|><|endoftext|> b", "<|endoftext|>", "   ", "\n", " x   y", "'", " '", "x '", "aaaaaaaaaaaaaaaa" * 30]
    for _ in range(400):
        out.append("".join(rnd.choice(rnd.choice([pool, "abc's \n'", "  thereou 12"])) for _ in range(rnd.randint(0, 50))))
    return out


def test_bpe_equals_the_library(spark, docs, plain, library):
    texts = dict(plain) | {1000 + i: t for i, t in enumerate(awkward_texts())}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for i, r in by_id(encode_decode(df, with_ids=True)).items():
        ids = library.encode(texts[i] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (len(ids), ids, sha(struct.pack(f"<{len(ids)}I", *ids)), sha(back)) == (r.n_tokens, r.ids, r.ids_sha256, r.decoded_sha256), texts[i]
        assert back == (texts[i] or "")
    assert encode_decode(df.limit(0)).count() == 0


def test_a_hash_collision_cannot_pass(monkeypatch, library):
    machine = bpe_module._compiled(default_vocabulary())
    monkeypatch.setattr(bpe_module.S, "hash_runs", lambda buf, s, e: (e - s).astype("uint64"))
    machine._forget()
    text = "some words with equal lengths than that were"
    assert machine.encode([text.encode()])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    machine._forget()


def test_automaton_gadgets_on_a_tiny_vocabulary(monkeypatch):
    """All words over a two-letter alphabet: the automaton's one path is what applying the merges in order gives."""
    letters = {v: k for k, v in bpe_module.byte_letters().items()}
    vocab = {letters[b]: b for b in range(256)}
    merges = [("a", "a"), ("a", "b"), ("aa", "a"), ("b", "b"), ("ab", "ab"), ("aa", "ab"), ("b", "a")]
    for k, (u, v) in enumerate(merges):
        vocab[u + v] = 256 + k
    import json

    machine = Automaton(json.dumps({"model": {"vocab": vocab, "merges": [list(m) for m in merges]}, "added_tokens": []}))

    def plain_bpe(word):
        parts = list(word)
        for u, v in merges:
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == (u, v):
                    out.append(u + v)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return [vocab[p] for p in parts]

    for n in range(1, 11):
        for bits in range(2**n):
            word = "".join("ab"[bits >> k & 1] for k in range(n))
            assert machine.encode_word(word.encode()) == plain_bpe(word), word
    # the table: a word met again is looked up only, and a full one starts anew
    monkeypatch.setattr(machine, "_transition", None)
    assert machine.encode_word(b"abbaabab" * 50) == plain_bpe("abbaabab" * 50)
    monkeypatch.undo()
    monkeypatch.setattr(bpe_module, "STATES", 3)
    for word in ("aabbaab", "bbbabaa", "ab" * 20):
        assert machine.encode_word(word.encode()) == plain_bpe(word) and len(machine._of) < 60


@pytest.mark.parametrize("rule", ["first", "most"])
def test_token_counts(spark, library, rule):
    texts = dict(enumerate([None, "", "one line", "ab\n\n\ncé日本\n x", "\n\n\n\n", "a\n" * 50, *awkward_texts()[:60]]))
    texts = {i: (t or "").replace("<|endoftext|>", "") if t is not None else None for i, t in texts.items()}
    got = collections.defaultdict(list)
    for r in token_counts(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), rule).collect():
        got[r.doc_id].append(r)
    for i, t in texts.items():
        t = t or ""
        spans, at = [], 0
        for part in re.findall(r"[^\n]*\n|[^\n]+$", t) or [""]:
            spans.append((at, at + len(part)))
            at += len(part)
        want = [0] * len(spans)
        offsets = library.encode(t, add_special_tokens=False).offsets
        for a, b in offsets:
            share = [max(0, min(b, v) - max(a, u)) for u, v in spans]
            want[share.index(max(share)) if rule == "most" else max(k for k, (u, _) in enumerate(spans) if u <= a)] += 1
        rows = sorted(got[i], key=lambda r: r.section)
        assert [(r.start_char, r.end_char) for r in rows] == spans, t
        assert [r.n_tokens for r in rows] == want, t
        assert {r.doc_tokens for r in rows} == {len(offsets)}


def test_licence_scan(spark):
    texts = dict(enumerate([
        None, "", "Released under the MIT License.", "released UNDER the mit-license; mit license", "mit\nlicense apache license mit license",
        "Licensed under CC BY-NC 4.0.", "GNU General Public License general public license", "the license of mit",
        "This work is licensed under the GNU General Public License, version 3.", "the " * 3000, "license " * 500 + "apache license",
        "under the terms of the gnu lesser general public license and more words",
    ]))
    got = by_id(licence_scan(spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, labels string")))
    for i, t in texts.items():
        w = ALNUM_WORD.findall(lower(t or ""))
        places, labels = [], set()
        for phrase, label in BASE_PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[i]
        want = (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert want == (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels), i
        assert labels <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert got[5].labels == "cc-by-nc" and got[7].labels == "" and got[8].labels == "gpl" and got[11].labels == "gpl,lgpl"


def brute_licences(texts, templates):
    """Labels, matches and best coverage of every template at every place of every text."""
    words = {i: ALNUM_WORD.findall(lower(t or "")) for i, t in texts.items()}
    out = {i: (set(), 0, 0.0) for i in texts}
    for label, key, text in templates:
        own, phrase = ALNUM_WORD.findall(lower(text)), key.split()
        at = next(k for k in range(len(own)) if own[k : k + len(phrase)] == phrase)
        idf = {w: math.log(1 + len(texts) / (1 + sum(w in held for held in map(set, words.values())))) for w in own}
        weight = sum(idf[w] for w in own)
        for i, w in words.items():
            for start in range(1 - len(own), len(w)):
                there = [k for k, x in enumerate(own) if 0 <= start + k < len(w) and w[start + k] == x]
                cover = sum(idf[own[k]] for k in there) / weight
                if cover >= 0.6 and set(range(at, at + len(phrase))) <= set(there):
                    labels, n, best = out[i]
                    out[i] = (labels | {label}, n + 1, max(best, cover))
    return out


def test_licence_templates_against_brute_force(spark):
    """Every template, whole and worn: words lacking at random, in the middle, and rare words that stand elsewhere in the file."""
    rnd = random.Random(31)
    long = " ".join(f"term{k}" for k in range(40))
    templates = [*TEMPLATES, ("house", "term20 term21", long)]
    texts, filler = {0: None, 1: "", 2: "All rights reserved."}, [f"f{k}" for k in range(50)]
    for label, _, text in templates:
        own = ALNUM_WORD.findall(lower(text))
        for share in (0.0, 0.2, 0.45):
            worn = [w if rnd.random() >= share else rnd.choice(filler) for w in own]
            texts[len(texts)] = " ".join([*rnd.choices(filler, k=9), *worn, *rnd.choices(filler, k=5), *(rnd.choices(own, k=9) if share else [])])
    # eight words lack in their place and stand elsewhere
    own = long.split()
    texts[len(texts)] = " ".join(own[:32] + ["x"] * 8 + ["y"] * 7 + own[32:])
    texts[len(texts)] = " ".join(["x"] * 8 + own[8:] + ["y"] * 5 + own[:8])
    got = by_id(licence_scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), templates))
    want = brute_licences(texts, templates)
    for i, (labels, n, best) in want.items():
        r = got[i]
        assert labels <= set(filter(None, r.labels.split(","))) and labels | set(filter(None, r.base_labels.split(","))) == set(filter(None, r.labels.split(","))), i
        assert r.n_matches == n and (r.score == pytest.approx(max(best, 0.6 if r.n_base else 0.0)))
    assert [got[i].labels for i in (len(texts) - 2, len(texts) - 1)] == ["house", "house"] and got[2].labels == "proprietary"


def test_decontamination(spark):
    rnd = random.Random(11)
    vocab = [f"q{i}" for i in range(200)] + ["the", "of"] * 20
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, f"{say(rnd.randint(8, 30))}.\n{say(rnd.randint(3, 20))}.") for i in range(30)]
    items += [(100, "Too short."), (101, None), (102, say(200) + ". " + say(50)), items[3], (103, "..."), (104, "seven words that stand in one text")]
    items += [(105, "solitary"), (106, say(20) + ".\none two three four five."), (107, say(20) + ".\nlonely.")]
    texts = {i: say(rnd.randint(1, 300)) for i in range(40)} | {40: None, 41: "", 42: "the " * 4000}
    planted = {}
    for i in range(50, 75):
        k = rnd.choice([x for x in items if x[1] and x[0] < 100 or x[0] == 102])
        text = k[1].upper() if i % 2 else k[1].replace(".\n", " -- ")
        planted[i] = k[0]
        texts[i] = say(rnd.randint(0, 150)) + " " + text + " " + say(rnd.randint(0, 150))
    half = items[5][1].split(".\n")
    texts[80] = say(50) + " " + half[0] + " " + say(50)   # the question without its answer
    # items of one to seven words, and one word edited in a short answer
    short, edited, lonely = (next(x for i, x in items if i == k) for k in (104, 106, 107))
    texts |= {81: say(60) + " too SHORT! " + say(20), 82: say(30) + " " + short + " " + say(30), 83: short.replace("that", "which") + " " + say(9)}
    texts |= {84: say(70) + " solitary " + say(70), 85: say(20) + " " + edited.replace("three", "3") + " " + say(9), 86: lonely.replace("lonely", "alone") + " " + say(20)}
    planted |= {81: 100, 82: 104, 84: 105, 85: 106}
    d = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, item_id long")
    b = spark.createDataFrame(items, "item_id long, text string")

    def grams(t):
        w = ALNUM_WORD.findall(lower(t))
        return w, lambda n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}

    bm25 = brute_bm25(texts, items)
    want = set()
    for i, t in texts.items():
        held, gram = grams(t or "")
        for k, x in items:
            own, own_gram = grams(x or "")
            if not own or bm25[i, k] < 0.5:
                continue
            if len(own) < 8:
                if own_gram(len(own)) <= gram(len(own)):
                    want.add((i, k))
                continue
            (asked, question), (said, answer) = ((min(5, len(w)), w) for w in (grams(p)[0] for p in question_and_answer(x)))
            share = lambda n, w: len({tuple(w[j : j + n]) for j in range(len(w) - n + 1)} & gram(n)) / len({tuple(w[j : j + n]) for j in range(len(w) - n + 1)})
            shares = [share(asked, question), share(said, answer)]
            if len(answer) < min(10, len(own)):
                mine = {tuple(question[j : j + asked]) for j in range(len(question) - asked + 1)}
                at = [j for j in range(len(held) - asked + 1) if tuple(held[j : j + asked]) in mine]
                ends = [j + asked for j in at if j + 1 not in at]
                shares[1] = max([shares[1], *(len(set(answer) & set(held[e : e + 2 * len(answer) + 2])) / len(set(answer)) for e in ends)])
            if min(shares) >= 0.6:
                want.add((i, k))
    got = contaminated(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(r.score == pytest.approx(bm25[r.doc_id, r.item_id]) for r in got)
    assert set(planted.items()) <= want and not any(i < 50 or i == 80 for i, _ in want)
    left = decontaminate(d, b)
    assert left.columns == d.columns and {r.doc_id for r in left.collect()} == set(texts) - set(planted)
    assert contaminated(d, b.limit(0)).count() == 0 and decontaminate(d.limit(0), b).count() == 0


def brute_bm25(texts, items):
    """Best score of a passage against an entry, as a share of the entry's own, by (text, item)."""
    split = lambda t: ALNUM_WORD.findall(lower(t or ""))
    entries = [(k, w[p : p + 64]) for k, w in {(k, tuple(split(x))) for k, x in items} for p in range(0, len(w), 64)]
    df = collections.Counter(x for _, e in entries for x in set(e))
    mean = sum(len(e) for _, e in entries) / len(entries)

    def impacts(e):
        tf = collections.Counter(e)
        return {x: math.log(1 + (len(entries) - df[x] + 0.5) / (df[x] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(e) / mean)) for x, n in tf.items()}

    best, scored = collections.defaultdict(float), [(k, impacts(e)) for k, e in entries]
    for i, t in texts.items():
        w = split(t)
        for p in range(0, max(1, len(w) - 64), 64):
            held = set(w[p : p + 128])
            for k, own in scored:
                best[i, k] = max(best[i, k], sum(v for x, v in own.items() if x in held) / sum(own.values()))
    return best


def test_decontamination_in_shards(spark, monkeypatch):
    """The same rows and scores however the benchmark is cut."""
    import cardwatch.llm.decontaminate as module

    rnd = random.Random(8)
    words = [[f"s{i}x{k}" if rnd.random() < 0.7 else f"common{rnd.randrange(9)}" for k in range(20)] for i in range(12)]
    b = spark.createDataFrame([(i, " ".join(w[:14]) + ". " + " ".join(w[14:])) for i, w in enumerate(words)], "item_id long, text string")
    d = spark.createDataFrame([(i, "a b c " + " ".join(w[:-2]) + " d e f common3") for i, w in enumerate(words)], "doc_id long, text string")
    whole = sorted(map(tuple, contaminated(d, b).collect()))
    assert {(r[0], r[1]) for r in whole} == {(i, i) for i in range(12)} and any(r[2] < 1 for r in whole)
    for size in (200, 700):
        monkeypatch.setattr(module, "SHARD_BYTES", size)
        assert sorted(map(tuple, contaminated(d, b).collect())) == whole
    assert decontaminate(d, b).count() == 0


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 600)
    monkeypatch.setattr(warc, "RANGE_ROWS", 4)
    rnd = random.Random(4)
    bodies = ["x" * 120, "é\r\n\r\nWARC/1.1\r\n\r\n" * 10, "short", "", None, "y" * 99, "y" * 100]
    rows = [(i, f"http://WWW.h{rnd.randrange(3)}.org/P{rnd.randrange(3)}?q#f", rnd.choice(bodies), "z") for i in range(40)]
    rows += [(None, "q\r\nw", "x" * 120, "z"), rows[3], (50, None, "x" * 120, "z")]
    # one page_id with several payloads, and revisits of each of them
    rows += [(5, "u", "a" * 200, "z"), (5, "u", "b" * 300, "z"), (57, "v", "a" * 200, "z"), (58, "v", "b" * 300, "z"), (59, "v", "b" * 300, "z"), (57, "v", "c" * 100, "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = archive_round_trip(df).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, body, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(body or "", i)
    want = collections.Counter()
    for i, _, body, _ in rows:
        raw = (body or "").encode()
        refers = first[body or ""] if i is not None and len(raw) >= 100 and first[body or ""] != i else None
        want[i, len(raw), sha(raw), "response" if refers is None else "revisit", refers] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    order = sorted(got, key=lambda r: (r.index_part, r.index_row))
    assert [(r.url_key, r.captured) for r in order] == sorted((r.url_key, r.captured) for r in got)
    assert len({r.index_part for r in got}) > 1 and any(r.url_key == "org,h1)/p2?q" for r in got)
    assert archive_round_trip(df.limit(0)).count() == 0


def test_loser_tree():
    rnd = random.Random(1)
    for k in range(0, 12):
        runs = [sorted(((rnd.randrange(9),), r, j) for j in range(rnd.randrange(6))) for r in range(k)]
        runs = [sorted(r, key=lambda x: x[0]) for r in runs]
        assert list(LoserTree(runs)) == sorted((x for r in runs for x in r), key=lambda x: (x[0], x[1]))


def test_toxicity(spark):
    from cardwatch.llm.toxicity import toxicity_scores, without_toxic

    rnd = random.Random(6)
    say = lambda n: " ".join(f"w{rnd.randrange(300)}" for _ in range(n))
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, say(20) + (" awful rotten " if bad else " ") + say(20), 0.9))
        labels.append((i, int(bad)))
    rows += [(1000, None, 0.9), (1001, "", 0.9), (1002, "AWFUL rotten", 0.9), (1003, "plain " * 3000, 0.9), (None, "w1", 0.9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    # held-out labels are all wrong: they must not matter
    flip = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    lab = spark.createDataFrame([*flip, (7, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity_scores(docs, lab).collect()}
    assert len(got) == len(rows)
    truth = dict(labels)
    for i, r in got.items():
        if i is not None:
            assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if i in truth:
            assert r.predicted == truth[i], i
    assert got[1002].predicted == 1 and got[1000].predicted == got[1001].predicted == got[1003].predicted == 0
    left = without_toxic(docs, lab)
    assert left.columns == docs.columns and left.count() == sum(1 - r.predicted for r in got.values())
    none = toxicity_scores(docs, lab.filter("toxic = 5")).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity_scores(docs.limit(0), lab).count() == 0


def test_labels_without_a_document_use_up_no_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, toxic int")
    rows = sample(docs, labels, 5).collect()
    assert sorted(r.toxic for r in rows) == [0] * 5 + [1] * 5


def test_counterfactual_swaps_calm_group_mentions(spark):
    """A group named mostly in toxic texts does not make a neutral mention toxic once swaps are penalised."""
    from cardwatch.llm.toxicity import GROUPS, swaps, toxicity_scores

    assert swaps("no group here") == [] and swaps("All WOMEN and gay men") == ["all men and lesbian girls", "all people and ordinary people"]
    for terms, neutral in GROUPS:  # within the list: language and word class stay
        for t in terms:
            other, plain = swaps(f"the {t.upper()}, they say")
            assert other.split()[1].strip(",") in set(terms) - {t} and plain.split()[1] == f"{neutral},"
    rnd = random.Random(8)
    say = lambda n: " ".join(f"w{rnd.randrange(300)}" for _ in range(n))
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        group = "muslims" if rnd.random() < (0.8 if bad else 0.02) else ""
        insult = "vile" if bad and rnd.random() < 0.7 else ""
        rows.append((i, f"{say(10)} {group} {insult} {say(10)}"))
        labels.append((i, int(bad)))
    rows.append((9000, "muslims meet in the town hall"))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    score = lambda mu: toxicity_scores(docs, lab, mu=mu).filter("doc_id = 9000").first().score
    assert score(5.0) < 0.6 < score(0.0)
