"""Functions that run in Python workers need no copy of the package there."""

from __future__ import annotations

import subprocess
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from rollcall.llm import conversations, jaccard, language_model, negatives, substring
from rollcall.llm.words import NOT_SPACE, Hasher


def test_functions_load_without_the_package(tmp_path):
    texts = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array(["a b c d e " * 9])], names=["row", "id", "text"])
    list(jaccard._described(4)(iter([texts])))  # what the driver's process has made must not travel
    given = {
        "described": jaccard._described(4), "listed": jaccard._listed(4, 85, np.zeros(4), 6, np.zeros(4, bool)),
        "bucket": substring._in_bucket(13), "packed": substring._packed(13, 2, np.zeros(0, np.uint64)), "bodies": language_model._bodies,
        "seated": language_model._scored(1, 1, 1, np.zeros(0, np.uint64), np.zeros(0, np.uint64)),
        "faults": conversations._described, "solved": conversations._solved, "edits": conversations._applied, "sums": conversations._hashed,
        "joined": negatives._joined(0.5, 5, True),
    }
    for name, function in given.items():
        data = cloudpickle.dumps(function)
        assert len(data) < 200_000, name
        (tmp_path / name).write_bytes(data)
    code = ("import pickle, sys; sys.path = [p for p in sys.path if 'repo' not in p]\n"
            f"for n in {list(given)!r}: pickle.load(open(n, 'rb'))\n"
            "import pyarrow as pa\n"
            "b = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array(['a b c d e'])], names=['row', 'id', 'text'])\n"
            "print(len(list(pickle.load(open('described', 'rb'))(iter([b])))))\n"
            "assert not any(m.startswith('rollcall') for m in sys.modules)")
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert found.returncode == 0 and found.stdout.strip() == "2", found.stderr


def test_pairs_are_dropped_without_the_package(tmp_path):
    (tmp_path / "close").write_bytes(cloudpickle.dumps(jaccard._close(85)))
    code = ("import pickle, sys; sys.path = [p for p in sys.path if 'repo' not in p]\n"
            "import pyarrow as pa\n"
            "b = pa.RecordBatch.from_pydict({'a': [1, 2], 'b': [3, 4], 'n_a': [9, 9], 'n_b': [9, 9],\n"
            "    'sketch_a': [b'a' * 8] * 2, 'sketch_b': [b'a' * 16, b'z' * 7 + b'a' * 9]})\n"
            "print([x.to_pydict() for x in pickle.load(open('close', 'rb'))(iter([b]))])\n"
            "assert not any(m.startswith('rollcall') for m in sys.modules)")
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert found.returncode == 0 and found.stdout.strip() == "[{'a': [], 'b': []}]", found.stderr


def test_long_words_over_two_letters_have_their_own_hashes():
    """A word and its complement, which polynomials modulo a power of two cannot tell apart from some length on."""
    word = "a"
    while len(word) < 4_096:
        word += word.translate(str.maketrans("ab", "ba"))
        other = word.translate(str.maketrans("ab", "ba"))
        data = np.frombuffer(f"{word} {other}".encode(), np.uint8)
        one, two = Hasher(NOT_SPACE).find(data, np.array([0, len(data)])).hashes
        assert one != two


def test_crafted_words_link_nothing(spark):
    word = "a"
    while len(word) < 1_024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"x {word} y z w v u"), (2, f"x {other} y z w v u"), (3, f"x {word} y z w v u")]
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.id: r.component for r in found.collect()} == {1: 1, 2: 2, 3: 1}
