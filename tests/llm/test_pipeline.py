"""The pipeline on the smallest table: stages take effect, keep clean documents, and the entry point registers it all."""

import collections
import random

import __spark_entry__ as entry
import corpus_pipeline
from cardwatch.llm.bpe import default_vocabulary
from cardwatch.llm.linededup import MIN_WORDS
from cardwatch.llm.spark_io import written
from tests.llm.test_operators import ALNUM_WORD, SPACE_WORD, brute_components, brute_lines, lower, sha


def test_stages_on_the_smallest_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    seen = collections.OrderedDict()
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_small), f"test-{name}")
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= set(before) and len(after) == docs.count()
        seen[name] = after
        if name != "bpe":
            assert docs.columns == columns
    assert list(seen) == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "bpe"]
    assert seen["bpe"] == seen["decontamination"]
    # exact copies are gone
    assert len(seen["bpe"]) < len(before)


def test_whole_run_equals_its_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_small), "test-run")
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_small).collect())) == sorted(map(tuple, docs.collect()))


def test_registered(spark):
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)


def planted():
    """(documents, labels, items, toxic ids): every stage has something to do, and copies that the line stage cuts."""
    rnd = random.Random(17)
    vocab = [f"word{k}" for k in range(3000)]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    page = lambda: "\n".join(say(rnd.randint(9, 25)) for _ in range(rnd.randint(4, 9)))
    texts = [page() for _ in range(150)]
    toxic = set(range(0, 60))
    for i in toxic:
        texts[i] += " " + " ".join(rnd.choice(["vilefilth", "scumrot", "hatespew"]) for _ in range(6))
    run = "\n".join(say(9) for _ in range(3))  # 27 words in three lines
    for i in (100, 110, 120):
        texts[i] = f"{texts[i]}\n{run}\n{say(12)}"
    for i in range(70, 100):
        texts[i] += "\nsubscribe to our weekly letter"
    for i in range(100, 125):  # near copies, a word or a line changed, and exact ones
        copy = texts[i].split("\n")
        if i % 3:
            k = rnd.randrange(len(copy))
            words = copy[k].split(" ")
            words[rnd.randrange(len(words))] = "changed"
            copy[k] = " ".join(words)
        texts.append("\n".join(copy))
    items = [(k, f"{say(20)}.\n{say(3)}.") for k in range(8)] + [(8, "four words standing here"), (9, None)]
    for k in range(9):
        texts.append(f"{say(40)} {items[k][1]} {say(40)}")
    texts += [None, "", "   ", "lonely"]
    docs = list(enumerate(texts))
    labels = [(i, int(i in toxic), 1) for i, _ in docs if i < 150]
    return docs, labels, items, toxic


def expected(docs, items, toxic):
    """The five stages in plain Python."""
    plain = {i: t for i, t in docs if i not in toxic}
    cut = brute_lines(plain, MIN_WORDS)
    here = {i: (t if not cut[i][1] else cut[i][2]) for i, t in plain.items() if cut[i][1] == 0 or cut[i][1] < cut[i][0]}
    for texts in (dict(docs), here):
        _, label = brute_components({i: texts[i] for i in here}, 5, 80)
        here = {i: t for i, t in here.items() if label[i] == i}
    held = lambda t: f" {' '.join(ALNUM_WORD.findall(lower(t or '')))} "
    return {i: t for i, t in here.items() if not any(x and held(x) in held(t) for _, x in items)}


def test_run_equals_plain_python(spark, tmp_path):
    from tokenizers import Tokenizer

    docs, labels, items, toxic = planted()
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], columns).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = expected(docs, items, toxic)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(want)
    library = Tokenizer.from_file(default_vocabulary())
    library.no_truncation()
    library.no_padding()
    for i, t in want.items():
        assert (got[i].n_tokens, got[i].decoded_sha256) == (len(library.encode(t or "", add_special_tokens=False).ids), sha(t or "")), i
    # each stage had its cases: no copy is left, not even as a fragment
    assert not set(got) & toxic and not set(got) & set(range(150, 175))
    assert not set(got) & set(range(175, 184)) and set(range(60, 150)) <= set(got)
    assert len(SPACE_WORD.findall(want[110] or "")) < len(SPACE_WORD.findall(dict(docs)[110]))


def test_texts_that_share_a_doc_id_go_or_stay_together(spark, tmp_path):
    say = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n))
    rows = [(1, say(1, 30)), (2, say(2, 30)), (2, say(3, 30)), (3, say(2, 30)), (4, say(4, 30)), (4, say(4, 30)), (None, "a"), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    left = corpus_pipeline.near_copies(spark, docs, str(tmp_path))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([rows[0], rows[1], rows[2], rows[4], (None, "a"), (None, "a")], key=str)
