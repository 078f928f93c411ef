import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidewire.llm import infill

MARKS = ("<P>", "<S>", "<M>")


def plainly(doc_id, text):
    """The same by slices of a list of units."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(x in text for x in MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    rnd = random.Random(3)
    alphabet = "ab<>PSM \né漢\U0001f642\x00"
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(600)]
    return out + [None, "", "<", "<P", "<P>", "P>", "<<S><", "word", " ", "x" * 300_000, "漢a" * 50_000] + ["same text"] * 40


def check(rows, got):
    assert len(got) == len(rows)
    want = sorted((str(i), t or "", *map(str, plainly(i, t))) for i, t in rows)
    assert want == sorted((str(r.doc_id), r.restored, *map(str, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output))) for r in got)


def test_equals_slices_of_units_and_restores(spark):
    rows = list(enumerate(odd_texts())) + [(None, "a null id, here"), (None, None), (5, "repeated row"), (5, "repeated row")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = infill.infill_documents(df.repartition(3)).collect()
    check(rows, got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_slices_do_not_show(spark, monkeypatch):
    rows = list(enumerate(odd_texts()))
    texts = [(t or "").encode() for _, t in rows]
    h = np.array([[int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * j : 8 * j + 8], 16) for j in range(4)] for i, _ in rows])
    whole = infill.rearrange(texts, h)
    at = np.cumsum(whole[1])
    for i in random.Random(0).sample(range(len(rows)), 50):
        one = infill.rearrange(texts[i : i + 1], h[i : i + 1])
        assert one[0].tobytes() == whole[0][at[i] - whole[1][i] : at[i]].tobytes()
        assert infill.restore(one[0], one[1], one[2])[0].tobytes() == texts[i]


def test_a_mark_split_over_two_rows_is_none():
    h = np.array([[0, 0, 95, 50], [1, 2, 0, 50], [1, 2, 0, 50]])
    texts = [b"ends in <P", b"> starts so <", b"M> and S>"]
    out, lengths, form, *_ = infill.rearrange(texts, h)
    assert form.tolist() == [infill.PLAIN, infill.PSM, infill.PSM]
    assert infill.restore(out, lengths, form)[0].tobytes() == b"".join(texts)


def test_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id int, text string, output string, n int")
    assert infill.infill_documents(df.where("false")).count() == 0
    row = infill.infill_documents(df).first()
    assert (row.doc_id, row.restored) == (1, "a b") and row.n == 3
    assert infill.infill_documents(df.withColumn("text", F.lit(None).cast("string"))).first().output == ""
