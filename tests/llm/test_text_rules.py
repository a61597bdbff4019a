"""Quality rules, spans, secrets and personal data against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewmill.llm import blob_ledger, disclosure, quality_rules, spans
from reviewmill.session import fresh_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, words string, spans string, findings string, blob string, digest string"


def docs_of(spark, texts):
    """Ids may repeat; the other columns clash with names that the operators use inside."""
    rows = [(i, t, "x", "x", "x", "x", "x") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    several = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if several[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    pieces = ["a", "b", "c", "the", "#", "\n", " ", "\t", "é", "", "\x0b", "日本"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return [None, "", " \n\t ", "one", "one two", "x " * 3000, "\n".join(["same line here"] * 80), *texts, *texts[:5]]


def test_quality_counts(spark, odd_texts):
    docs = docs_of(spark, enumerate(odd_texts))
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert len(got) == len(odd_texts)
    for i, text in enumerate(odd_texts):
        row, want = got[i], counted(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row.kept and row.base_failed)


def test_quality_hash_ties_fall_back_to_words(spark, odd_texts):
    """With a constant for every word's hash all windows share their bits, and only the words tell them apart."""
    docs = docs_of(spark, enumerate(odd_texts[:60])).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    items = quality_rules.words(F.col("text"))
    cut = docs.select("doc_id", items.alias("w")).withColumn("packed", quality_rules._packed_windows(F.transform("w", lambda _: F.lit(7).cast("long"))))
    got = {r.doc_id: r.n for r in cut.select("doc_id", quality_rules._repeat_words(F.col("w"), F.col("packed")).alias("n")).collect()}
    assert got == {i: counted(t)[4] for i, t in enumerate(odd_texts[:60])}


def test_quality_verdicts_and_empty_table(spark):
    clean = " ".join(f"the word{i} of text{i} and" for i in range(40))
    rows = [(1, clean), (2, " ".join("# $ the of and" if i % 2 else f"w{i}" for i in range(90))), (3, " ".join(f"xq{i}" for i in range(200)))]
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs_of(spark, rows)).collect()}
    assert got[1].kept and got[1].failed_rules == []
    assert not got[2].kept
    assert not got[3].kept and got[3].failed_rules == ["stop_words"]
    assert quality_rules.quality_rules(docs_of(spark, [])).count() == 0


def test_spans_many_matches(spark):
    text = "é1 " * 1000 + "22"
    found = spark.createDataFrame([(text,), ("",), ("none",)], "text string").select(spans.find(F.col("text"), "[0-9]+").alias("s")).collect()
    assert [(s.start, s.end, s.value) for s in found[0].s] == [(*m.span(), m[0]) for m in re.finditer("[0-9]+", text)]
    assert found[1].s == [] and found[2].s == []


SECRETS = [
    None, "", "nothing here", 'api_key = "abcdefghijkl1234"', "Token: short", "token=secret: abcdefghijklmnop", "PASSWD='AAAAAAAAAAAA' x",
    "AKIA" + "A" * 13, "AKIA" + "A" * 14, "AKIAAKIA" + "Z9" * 6, "deadbeefdeadbeef", "deadbeefdeadbee", "é" * 9 + " 0123456789abcdef" * 300,
    "secretsecret = xxxxxxxxxxxx apikey:'aaaaaaaaaaaaa' aPi_KeY=bbbbbbbbbbbbbb", "f" * 40_000, "password " * 500,
]


def secret_spans(text):
    text, kinds = text or "", ("assign", "access", "hex")
    found = [("assign", *m.span()) for m in re.finditer(
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0])))


def test_ledger_scans_unseen_blobs_only(spark):
    rows = [*enumerate(SECRETS), (None, SECRETS[3]), (3, SECRETS[3])]
    versions, path = docs_of(spark, rows), fresh_path(spark, "ledger-test")
    blob_ledger.update_ledger(versions, path)
    first = spark.read.parquet(path)
    assert first.count() == len({t or "" for t in SECRETS})
    got = blob_ledger.findings(versions, path).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: [(s.kind, s.start, s.end) for s in r.findings] for r in got}
    assert by_id[None] == by_id[3]
    for i, text in enumerate(SECRETS):
        assert by_id[i] == secret_spans(text), text
    blob_ledger.update_ledger(docs_of(spark, [*rows, (90, "a new one: deadbeefdeadbeef00")]), path)
    assert spark.read.parquet(path).count() == first.count() + 1
    blob_ledger.update_ledger(versions, path, version="2")
    assert spark.read.parquet(path).where("rules = '2'").count() == first.count()
    assert blob_ledger.findings(docs_of(spark, []), path).count() == 0


def test_redact_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, 'a token = "abcdefghijklmnop" b', "en"), (2, "plain", "en"), (3, None, None), (3, None, None)], "doc_id long, text string, lang string")
    path = fresh_path(spark, "ledger-test")
    blob_ledger.update_ledger(docs, path)
    got = sorted(map(tuple, blob_ledger.redact(docs, path).collect()))
    assert got[0] == (1, 'a [assign]" b', "en") and got[1] == (2, "plain", "en") and got[2:] == [(3, None, None)] * 2


PRIVATE = [
    None, "", "plain", "mail a.b@c.de, x@y and a@b.c_d@e.f", "at a@b c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 000.0.0.255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "+1 (555) 010-9999, +49 30 +1 2", "é" * 5 + "user@host.org " * 200, "1" * 30_000, "a" * 30_000 + "@", "9" * 17, "0 " * 200, "++1234567890) x",
]


def luhn(digits):
    numbers = [int(d) for d in reversed(digits)]
    return (sum(numbers[::2]) + sum(sum(divmod(2 * n, 10)) for n in numbers[1::2])) % 10 == 0


def private_spans(text):
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)] if "@" in text and len(text) < 20_000 else []
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))] if len(text) < 20_000 else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


def test_base_personal_data(spark):
    docs = docs_of(spark, [*enumerate(PRIVATE), (3, PRIVATE[3]), (None, PRIVATE[3])])
    got = disclosure.personal_data(docs, support=50).collect()
    assert len(got) == len(PRIVATE) + 2
    by_id = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in got}
    for i, text in enumerate(PRIVATE):
        assert by_id[i] == private_spans(text), text[:50]
    assert by_id[None] == by_id[3]
    assert disclosure.personal_data(docs_of(spark, [])).count() == 0


def test_disclosing_terms_and_sanitise(spark):
    rows = [(i, f"The zanthic{'' if i % 2 else ','} order number{i} from bob@shop.org came") for i in range(4)]
    rows += [(10 + i, f"the order of day{i} came from here, plain text") for i in range(12)]
    docs = docs_of(spark, rows)
    got = {r.doc_id: [(s.kind, rows[0][1][s.start:s.end]) for s in r.spans] for r in disclosure.personal_data(docs).where("doc_id = 0").collect()}
    assert got[0] == [("email", "bob@shop.org"), ("reveal", "zanthic")]
    plain = disclosure.personal_data(docs).where("doc_id >= 10").collect()
    assert len(plain) == 12 and all(r.spans == [] for r in plain)
    clean = {r.doc_id: r for r in disclosure.sanitise(docs).collect()}
    assert clean[0].text == "The [], order number0 from [email] came" and clean[0].spans == "x"
    assert clean[10].text == rows[4][1] and len(clean) == len(rows)


def test_query_digest_follows_spans(spark, sf_dir):
    from reviewmill.llm.queries import op4_disclosure, op5_blob_ledger

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for query, expected, names in ((op4_disclosure, private_spans, ("email", "ip", "card", "phone")), (op5_blob_ledger, secret_spans, ("assign", "access", "hex"))):
        rows = query(spark, sf_dir).collect()
        assert len(rows) == len(texts)
        for row in rows:
            want = expected(texts[row.doc_id])
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
            assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert [row[f"n_{name}"] for name in names] == [sum(k == name for k, _, _ in want) for name in names]
            assert row.spans.startswith(joined)
