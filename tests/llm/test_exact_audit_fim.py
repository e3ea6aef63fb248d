"""Exact dedup, filter audit and fill-in-the-middle against brute force: nulls, empty and long texts,
ties, repeated rows, empty tables, clashing columns, one group with a third of all rows."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from cardwatch.llm import exactdup, fim
from cardwatch.llm import scan as S
from cardwatch.llm.exactdup import exact_dedup, exact_duplicates
from cardwatch.llm.filteraudit import filter_audit
from cardwatch.llm.fim import fill_in_middle, restore_middle, round_trip

SPACE = re.compile("[\x20\x09-\x0d]+")
WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def corpus():
    rnd = random.Random(2)
    texts = [None, "", " ", "\t\n", "a b", "a  b", "a\x0bb", "a b ", "é <P> x", "日本語" * 50, "A#B", "x" * 200_000, ("W w " * 300)]
    for _ in range(60):
        texts.append(" ".join(rnd.choice(["red", "Green", "blue", "ü", "NO", "$5", "q"]) for _ in range(rnd.randint(1, 250))))
    rows = [(i, t, rnd.choice(["s0", "s1", None, ""])) for i, t in enumerate(texts)]
    rows += [(i + 1000, rnd.choice(texts), "s0") for i in range(80)]
    rows += [(i + 2000, "one hot text", "hot") for i in range(100)]
    rows += [rows[20], rows[20], (None, "one hot text", "s1"), (None, texts[30], "s0"), (None, "only here", "s0"), (None, "only here", "s0")]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    clashing = "doc_id long, text string, source string, n long, kept boolean, digest string, place int, form string, mask int"
    return spark.createDataFrame([(*r, 7, False, "d", 3, "f", 9) for r in rows], clashing).repartition(5)


def brute_exact(rows):
    by_text = collections.defaultdict(list)
    for i, t, _ in rows:
        by_text[SPACE.sub(" ", t or "")].append(i)
    out = []
    for t, ids in by_text.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        out += [(i, ids[0], len(ids), k == 0, sha(t)) for k, i in enumerate(ids)]
    return sorted(out, key=str)


@pytest.mark.parametrize("rounds", [None, 1, 3])
def test_exact_duplicates(docs, rows, rounds, monkeypatch):
    monkeypatch.setattr(exactdup, "HOT_SHARE", 20)  # groups on both sides of the bound
    got = exact_duplicates(docs, rounds)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_exact(rows)
    assert exact_duplicates(docs.limit(0), rounds).count() == 0


def test_exact_dedup_keeps_rows_whole(docs, rows):
    want = sorted({(r[0], r[4]) for r in brute_exact(rows) if r[3]}, key=str)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, sha(SPACE.sub(" ", r.text or ""))) for r in kept.collect()), key=str) == want


def test_rounds_grow_with_the_rows():
    assert exactdup.rounds_for(0) == exactdup.LEAST_ROUNDS
    for rows in (10**7, 10**9, 5 * 10**10):
        n = exactdup.rounds_for(rows)
        assert exactdup.FAN**n * exactdup.PLACE_ROWS >= rows > exactdup.FAN ** (n - 1) * exactdup.PLACE_ROWS or n == exactdup.LEAST_ROUNDS


def test_a_run_holds_a_digest_once(docs):
    """Every level: sorted within its place, one entry per digest, places of the last digits' exchange."""
    rows = exactdup.digests(docs)
    runs = exactdup.merged_runs(rows.selectExpr("0 AS place", "digest", "chars", "doc_id AS first_id", "row AS first_row", "1L AS n").coalesce(1))
    entries = [bytes(r.digest) for r in runs.collect()]
    assert entries == sorted(set(entries))
    home = exactdup.merged_runs(exactdup.exchanged(runs, 0, 8)).collect()
    assert all(r.place == int(bytes(r.digest).hex()[:15], 16) % 8 for r in home)


def fails(t, later):
    w = WORD.findall(t)
    return {
        "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= x <= "Z" for x in t) > 2 * len(t),
        "D": bool(set(t) & set("#$%&*|")), "E": later,
    }


def test_filter_audit(spark, docs, rows):
    rnd = random.Random(4)
    labels = [(r[0], rnd.choice([0, 1, None]), rnd.choice([0, 0, 1])) for r in rows if rnd.random() < 0.6]
    labels += [(5, 0, 1), (5, 1, 0), (None, 1, 1), (10**6, 1, 1)]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = collections.defaultdict(list)
    for i, t, s in rows:
        parts[s or ""].append((i, fails(t or "", i is not None and i > least[t or ""])))
    want = set()
    for part, members in parts.items():
        total = collections.Counter()
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                gone = [i for i, x in left if x[f]]
                left = [(i, x) for i, x in left if not x[f]]
                total[f] += len(gone)
                redundant = sum(x[f] for _, x in members) - len(gone)
                unique = sum(x[f] and sum(x.values()) == 1 for _, x in members)
                steps.append((f, ("".join(order), step, len(left), len(gone), redundant, unique, sum(i in good for i in gone), sum(i in toxic for i in gone))))
        want |= {(part, *s, total[f]) for f, s in steps}
    frame = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, text string")
    got = filter_audit(docs, frame).collect()
    assert len(got) == len(want) == 600 * len(parts)
    assert {tuple(r) for r in got} == want
    assert filter_audit(docs.limit(0), frame).count() == 0
    assert {r.good_lost + r.toxic_lost for r in filter_audit(docs, frame.limit(0)).collect()} == {0}


def brute_middle(i, t):
    h = sha(f"1:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(t)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (i, n, "plain", None, None, t)
    a, m, z = t[:lo], t[lo:hi], t[hi:]
    if h4 % 100 < 20:
        return (i, n, "spm", lo, hi - lo, f"<S>{z}<P>{a}<M>{m}")
    return (i, n, "psm", lo, hi - lo, f"<P>{a}<S>{z}<M>{m}")


def test_fill_in_middle(docs, rows, monkeypatch):
    want = sorted((brute_middle(i, t or "") for i, t, _ in rows), key=str)
    made = fill_in_middle(docs)
    got = [tuple(r) for r in made.collect()]
    assert sorted(got, key=str) == want
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    assert sorted((r.doc_id, r.restored) for r in restore_middle(made).collect() if r.doc_id is not None) == sorted((i, t or "") for i, t, _ in rows if i is not None)
    digests = sorted(((i, n, f, p, m, sha(o)) for i, n, f, p, m, o in got), key=str)
    rt = round_trip(docs).collect()
    assert sorted((tuple(r)[:6] for r in rt), key=str) == digests
    assert sorted(r.restored_sha256 for r in rt) == sorted(sha(t or "") for _, t, _ in rows)
    assert round_trip(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_scatter_and_gather_in_blocks(block, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", block)
    rnd = random.Random(block)
    texts = ["".join(rnd.choice("aé日<>PSM\n") for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    c = S.chunk_of(np.arange(300), [t.encode() for t in texts])
    n, form, low, high, cut1, cut2 = fim._split_places(c, list(range(300)))
    out, end = fim.scatter(c, form, cut1, cut2)
    made = fim._strings(out, end).to_pylist()
    assert made == [brute_middle(i, t)[5] for i, t in enumerate(texts)]
    back, end = fim.gather(S.chunk_of(np.arange(300), [m.encode() for m in made]), form)
    assert fim._strings(back, end).to_pylist() == texts


def test_gather_refuses_outputs_that_do_not_fit_their_form():
    for out, form in ((b"<P>a<S>b", 1), (b"<S>a<P>b<M>c", 1), (b"x<P>a<S>b<M>c", 1)):
        with pytest.raises(ValueError):
            fim.gather(S.chunk_of(np.zeros(1), [out]), np.array([form]))
