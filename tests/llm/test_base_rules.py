"""Operators 1, 4 and 10 against plain Python over the same rows."""

import hashlib
import re

import pytest

from basketry.llm import pii, quality_rules, secret_ledger
from basketry.llm.secret_ledger import RULES, Ledger

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \t ", "a@b.c_d@e.f x@y.z%q@w.e", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.0003.4", "4111 1111 1111 1111 x 4111111111111112",
       "+1 (2) 3456789-0 +12+123456789", "\U0001F600 a@b.co \U0001F600 1.1.1.1", "9" * 3000 + " " + "a" * 3000 + "@",
       "token: secret=abc password:token API_KEY=\"abcdef\" apikey='x'", "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 10 + " " + "0123456789abcdef" * 3 + " Secret : = zzzzzz",
       "w " * 60, "one two three four five six\n\n#*$ x\nsame\nsame\n", "a b c d e f a b c d e g h i j k l m n o"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(None, "null id a@b.co", "x"), (3, ODD[3], "again")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(13, 1), (11, 0), (None, 1)], "doc_id long, quality int")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def luhn(digits):
    return sum((lambda v: v // 10 + v % 10)(int(c) * (1 + i % 2)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_pii(t):
    t, digits = t or "", lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


def base_secrets(t):
    t, names = t or "", "password|passwd|secret|token|api_?key"
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(rf"""(?ai:({names}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_pii_base_spans(docs):
    got = pii.pii_digest(pii.find_pii(docs))
    assert got.count() == docs.count()
    for i, r in by_id(got).items():
        text = "null id a@b.co" if i is None else ODD[i]
        assert r.base_sha256 == hashlib.sha256(base_pii(text).encode()).hexdigest(), text
        assert set(filter(None, base_pii(text).split(","))) <= set(r.spans.split(","))


def test_pii_masking(spark, docs):
    got = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert got[7] == "\U0001F600 [email] \U0001F600 [ip]" and got[0] is None and got[12] == ODD[12]
    assert pii.masked(docs.limit(0)).count() == 0
    assert pii.masked(docs).columns == docs.columns


def test_secret_base_spans(docs):
    got = secret_ledger.secret_scan(docs)
    assert got.count() == docs.count()
    for i, r in by_id(got).items():
        text = "" if i is None else ODD[i]
        assert r.base_sha256 == hashlib.sha256(base_secrets(text).encode()).hexdigest(), text


def test_ledger_scans_only_what_is_new(spark, tmpdir_path):
    ledger = Ledger(spark, tmpdir_path)
    one = spark.createDataFrame([("a", "token=abcdefgh"), ("b", "token=abcdefgh"), ("c", "none")], "path string, text string")
    assert {r.path: len(r.findings) for r in ledger.update(one, RULES[:3], "path").collect()} == {"a": 1, "b": 1, "c": 0}
    assert ledger.rows().count() == 2 * 3  # two blobs, three rules
    two = one.unionAll(spark.createDataFrame([("d", "token=abcdefgh"), ("e", "password: hunter22")], "path string, text string"))
    assert {r.path: len(r.findings) for r in ledger.update(two, RULES[:3], "path").collect()} == {"a": 1, "b": 1, "c": 0, "d": 1, "e": 1}
    assert spark.read.parquet(ledger.parts[1]).count() == 3  # the one new blob
    again = ledger.update(two, RULES[:4], "path")
    assert again.count() == 5 and {r.rule for r in spark.read.parquet(ledger.parts[2]).collect()} == {RULES[3].key}


def test_ledger_goes_on_after_a_restart_and_a_failed_update(spark, tmpdir_path):
    one = spark.createDataFrame([("a", "token=abcdefgh"), (None, None)], "path string, text string")
    Ledger(spark, tmpdir_path).update(one, RULES[:2], "path").count()
    # an update that died: rows, but no mark of completion
    left = f"{tmpdir_path}/update-000001-dead"
    spark.createDataFrame([("x", "assign@1", "assign", [])], Ledger.SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(left)
    ledger = Ledger(spark, tmpdir_path)
    assert len(ledger.parts) == 1 and ledger.rows().count() == 2 * 2
    two = one.unionAll(spark.createDataFrame([("b", "secret: hunter22")], "path string, text string"))
    assert {r.path: len(r.findings) for r in ledger.update(two, RULES[:2], "path").collect()} == {"a": 1, None: 0, "b": 1}
    assert spark.read.parquet(ledger.parts[1]).count() == 2  # the new blob, two rules
    again = Ledger(spark, tmpdir_path)
    assert again.parts == ledger.committed() and {r.path: len(r.findings) for r in again.update(two, RULES[:2], "path").collect()} == {"a": 1, None: 0, "b": 1}
    assert spark.read.parquet(again.parts[2]).isEmpty()
    assert secret_ledger.secret_scan(one.limit(0).withColumnRenamed("path", "doc_id")).count() == 0


def base_rules(t):
    t = t or ""
    w = WORD.findall(t)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    repeated = {x for x in windows if windows.count(x) > 1}
    covered = {i + k for i, x in enumerate(windows) if x in repeated for k in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(docs, labels):
    got = quality_rules.quality_rules(docs, labels)
    assert got.count() == docs.count()
    for i, r in by_id(got).items():
        want = base_rules("null id a@b.co" if i is None else ODD[i])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)
    assert quality_rules.quality_rules(docs.limit(0), labels).count() == 0
