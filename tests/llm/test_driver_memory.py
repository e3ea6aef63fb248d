"""What the driver holds: neither the compiled automaton nor a Python object for every feature of the sample."""

import math
import random
import shutil
import subprocess
import sys

import numpy as np
import pyarrow as pa

from cardwatch.llm import bpe
from cardwatch.llm import toxicity as tox


def test_the_driver_never_builds_the_automaton(spark, monkeypatch, tmp_path):
    path = shutil.copy(bpe.default_vocabulary(), f"{tmp_path}/vocabulary.json")
    docs = spark.createDataFrame([(1, "some words, and 12 more"), (2, None)], "doc_id long, text string")
    want = sorted(map(tuple, bpe.encode_decode(docs).collect()))

    def never(*_):
        raise AssertionError("built in the driver")

    monkeypatch.setattr(bpe, "code_point_classes", never)  # workers import their own
    monkeypatch.setattr(bpe.Automaton, "__setstate__", never)
    assert sorted(map(tuple, bpe.encode_decode(docs, path).collect())) == want


def test_code_points_are_classified_in_little_memory():
    code = (
        "import re; from cardwatch.llm import bpe\n"
        "peak = lambda: int(re.search(r'VmHWM:\\s+(\\d+)', open('/proc/self/status').read())[1]) // 1024\n"
        "before = peak(); bpe.code_point_classes(); print(peak() - before)"
    )
    grown = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=bpe.__file__.split("/cardwatch/")[0]).stdout
    assert int(grown) < 100


def test_fit_over_arrow_columns():
    rnd, n, mu = random.Random(4), 40, 1.5
    some = lambda k: sorted(rnd.sample(range(n), rnd.randint(0, k)))
    rows = [(int(i % 3 == 0), some(12), [some(9), some(9)] if i % 5 == 0 else []) for i in range(90)]
    y, features, swapped = zip(*rows, strict=True)
    columns = pa.array(y, pa.int32()), pa.array(features, pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.list_(pa.int32())))
    weights, intercept = tox.fit(*columns, n, mu)

    w, b, g2, b2 = [0.0] * n, 0.0, [1e-8] * n, 1e-8
    pairs = [(set(f), set(s)) for _, f, swaps in rows for s in swaps]
    for _ in range(tox.STEPS):
        g, gb = [tox.RIDGE * x for x in w], 0.0
        for label, f, _ in rows:
            e = (1 / (1 + math.exp(-sum(w[k] for k in f) - b)) - label) * 0.5 / y.count(label)
            gb += e
            for k in f:
                g[k] += e
        for x, s in pairs:
            change = sum(w[k] for k in x - s) - sum(w[k] for k in s - x)
            for k in x ^ s:
                g[k] += (1 if k in x else -1) * change * 2 * mu / len(pairs)
        g2 = [a + d * d for a, d in zip(g2, g, strict=True)]
        w = [x - tox.RATE * d / math.sqrt(a) for x, d, a in zip(w, g, g2, strict=True)]
        b2 += gb**2
        b -= tox.RATE * gb / math.sqrt(b2)
    assert np.allclose(weights, w, atol=1e-6) and abs(intercept - b) < 1e-6
