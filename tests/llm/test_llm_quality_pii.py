import random
import re

import pytest
from pyspark.sql import functions as F

from tidewire.llm import pii, quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORDS.findall(text or "")
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def texts():
    rnd = random.Random(5)
    out = [None, "", " \n\t", "one", "a b\na b\n\na b \na b", "x " * 300, "é漢 🙂\u00a0y #*$%&|<>", "\x0b".join(["w"] * 30)]
    for _ in range(60):
        out.append("".join(rnd.choice(["ab ", "c ", "d\n", "e\t", "# ", "fé "]) for _ in range(rnd.randint(0, 400))))
    base = " ".join(f"w{i}" for i in range(60))
    out += [base, base + " " + base[:200], base + "\n" + base, " ".join(str(i % 23) for i in range(5000))]
    return out


def test_counts_match_brute_force(spark):
    rows = [(i, t, -1) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = {r["doc_id"]: r for r in quality.text_counts(df).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for i, t, _ in rows:
        assert tuple(got[i][n] for n in names) == brute_counts(t), repr(t)[:200]


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(60)]
        bad = i % 6 == 0
        if bad:
            words = [w + "###" for w in words]
        docs.append((i, " ".join(words), "extra"))
        if i % 3 == 0:
            labels.append((i, 0 if bad else 1, 0))
    docs += [(None, None, ""), (5, "", ""), (5, "", "")]
    labels += [(None, 1, None), (3, None, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, rule string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_list_generalises_to_unlabelled_rows(labelled):
    docs, labels = labelled
    judged, model = quality.judge(docs, labels)
    assert model.rules and all("reject if" in str(r) for r in model.rules)
    got = judged.collect()
    assert len(got) == 903
    for r in got:
        if r["base_failed"]:
            assert not r["kept"]
        else:
            assert r["kept"] == (r["doc_id"] % 6 != 0)
            assert (r["rule"] is None) == r["kept"]
    kept, _ = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 750


def test_without_labels_only_base_rules_reject(labelled):
    docs, labels = labelled
    judged, model = quality.judge(docs, labels.where("false"))
    assert model.rules == () and judged.where("NOT kept").count() == 3
    assert quality.judge(docs.where("false"), labels)[0].count() == 0


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def swap(spark, values, key=pii.KEY):
    df = spark.createDataFrame([(v,) for v in values], "text string")
    return [r[0] for r in df.select(pii.pseudonymize(F.col("text"), key)).collect()]


VALID = {
    r"mail [a-z]{4}\.\d\d@mail4\.example\.com end": "mail bgta.64@mail4.example.com end",
    r"\+1 \(\d{3}\) \d{3}-\d{4}": "+1 (648) 555-1250",
    r"\d{16}": "4336147440738033",
    r"\d{4}-\d{4}-\d{4}-\d{4}": "4111-1111-1111-1111",
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}": "78.241.210.149",
    r"\d{4}-\d\d-\d\d": "2024-02-29",
    r"\d\d\.\d\d\.\d{4}": "31.12.1999",
    r"DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d": "DE89 3704 0044 0532 0130 00",
    r"\d{3}-\d\d-\d{4}": "123-45-6789",
    r"password=[a-z0-9]{18} x": "password=380aeb1a432fe9347b x",
}


def test_valid_values_change_within_their_format(spark):
    got = swap(spark, list(VALID.values()))
    for (form, before), after in zip(VALID.items(), got):
        assert after != before and re.fullmatch(form, after), (before, after)
    assert luhn(got[2]) and luhn(got[3].replace("-", "")) and all(int(x) < 256 for x in got[4].split("."))
    iban = got[7].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


BESIDE = [
    "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "3782 822463 10005", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000",
    "FR14 2004 1010 0505 0001 3M02 606", "+33 1 23 45 67 89", "-john@x.org", "_a@x.org", "192.168.10.7", "2021-03-04", "123-45-6789", "password=" + "aB3" * 60,
]


FRAMES = ["{}", "qty 2 {} 123", "{} 12/27", "A {} BIC COBADEFFXXX", "NO12 {} EUR 17 OK", "IBAN {} 99", "_ {}, x", "7 {}"]


def test_values_are_found_beside_numbers_and_capitals(spark):
    cases = [(f.format(v), [v]) for v in BESIDE for f in FRAMES] + [(f"{v} {w}", [v, w]) for v in BESIDE for w in BESIDE]
    left = []
    for (before, values), after in zip(cases, swap(spark, [c[0] for c in cases])):
        if any(v.lstrip("-") in after for v in values):
            left.append((before, after))
    assert not left


def test_invalid_values_and_plain_texts_stay(spark):
    rows = [None, "", "no data", "4336147440738034", "999.1.1.1", "2024-02-30", "000-12-1234", "DE00 3704 0044 0532 0130 00", "a 12 b @ c", "1.2.3"]
    assert swap(spark, rows) == rows


def test_equal_values_stay_linked_and_keys_differ(spark):
    a, b, c = swap(spark, ["x 31.12.1999 y a.b@c.org a.b@c.org", "z 12/31/1999", "4111111111111111, 4111111111111111"])
    first, second = re.findall(r"\S+@c\.org", a)
    assert first == second
    day = re.search(r"\d\d\.\d\d\.\d{4}", a).group().split(".")
    assert re.search(r"\d\d/\d\d/\d{4}", b).group().split("/") == [day[1], day[0], day[2]]
    assert len(set(c.split(", "))) == 1
    assert swap(spark, ["4336147440738033"], "other") != swap(spark, ["4336147440738033"])


def test_permutations_are_one_to_one(spark):
    numbers = spark.range(319 * 229).select(pii.permute_number(F.col("id"), 319, 229, "k", "d").alias("x"))
    assert numbers.distinct().count() == 319 * 229 and numbers.where("x < 0 OR x >= 73051").count() == 0
    digits = spark.range(1000).select(pii.permute_text(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("x"))
    assert digits.distinct().count() == 1000 and digits.where("x NOT RLIKE '^[0-9]{3}$'").count() == 0


def test_columns_and_repeated_rows_stay(spark):
    df = spark.createDataFrame([(1, "ip 1.2.3.4", "k"), (1, "ip 1.2.3.4", "k"), (None, None, None)], "doc_id long, text string, key string")
    out = pii.pseudonymize_documents(df)
    assert out.columns == df.columns and out.count() == 3 and out.where("doc_id = 1").distinct().count() == 1
