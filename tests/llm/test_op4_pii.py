import hashlib
import random
import re

from llm_rows import *  # noqa: F403

from gateflow.llm import pii, queries


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(digits[::-1])) % 10 == 0


def brute(t):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= len(digits(m)) <= 15]


def base(t):
    return [s for s in pii.find(t, pii._automaton()) if s[0] in pii.BASE_KINDS]


def test_base_equals_patterns():
    r = random.Random(3)
    for _ in range(5000):
        letters = r.choice(["01 -", "0123456789 -.", "ab@.+1-", "+1 ().-2", "@a.b", "12.3", "1234567890", "é1.+@ -"])
        t = "".join(r.choice(letters) for _ in range(r.randrange(60)))
        assert base(t) == brute(t), t


def test_added_spans_and_mask():
    t = 'see https://a.example/x?y=1. token = "abc123def456789" mail me@b.org, +1 (974) 555-3436 ok'
    spans = pii.find(t, pii._automaton())
    assert [(k, t[a:b]) for k, a, b in spans] == [
        ("email", "me@b.org"), ("phone", "+1 (974) 555-3436"), ("url", "https://a.example/x?y=1"),
        ("secret", "abc123def456789")]
    assert pii.masked(t, spans) == 'see [URL]. token = "[SECRET]" mail [EMAIL], [PHONE] ok'
    assert pii.masked("abcdef", [("x", 1, 4), ("y", 2, 5)]) == "a[X]f"


def test_query_equals_brute_force(spark):
    for r in queries.op4_pii(spark, "/root/testdata/sf0.001").join(
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id").collect():
        want = brute(r.text or "")
        line = ",".join(":".join(map(str, s)) for s in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in pii.BASE_KINDS]
        assert r.spans == line or r.spans.startswith(line)


def test_odd_rows(docs):
    texts = [*ODD, "a@b.co " * 50_000, "1" * 100_000, "@" * 1000, "+" * 1000 + "1"]
    df = docs([*texts, *texts], [*range(len(texts)), *[None] * len(texts)])
    rows = pii.detect(df).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        if r.doc_id is not None:
            assert [tuple(s) for s in r.spans if s.kind in pii.BASE_KINDS] == brute(texts[r.doc_id] or "")
    masked = pii.redact(df)
    assert masked.columns == df.columns and masked.where("text is null").count() == 2
    assert pii.digests(pii.detect(docs([]))).count() == 0 and pii.redact(docs([])).count() == 0


def test_accounts_and_ibans():
    anchors = pii._automaton()

    def added(t):
        return [(k, t[a:b]) for k, a, b in pii.find(t, anchors) if k in ("secret", "account", "iban")]

    iban = "DE89 3704 0044 0532 0130 00"
    assert added(f"IBAN: {iban} and more") == added(f"account IBAN {iban}.") == [("iban", iban)]
    assert added("IBAN DE89370400440532013000") == [("iban", "DE89370400440532013000")]
    assert added("iban no. GB82-WEST-1234-5698-7654-32") == [("iban", "GB82-WEST-1234-5698-7654-32")]
    assert added("IBAN: DE88 3704 0044 0532 0130 00") == []
    assert added("account number 12345678") == added("Account: 12345678") == [("account", "12345678")]
    assert added("account no. 1234 5678-90, so") == [("account", "1234 5678-90")]
    assert added("account: abc123def456789") == [("secret", "abc123def456789")]
    assert added("account 1234567") == added("accounts of 12345678") == added("account 2019-01-02") == []
    t = f"IBAN: {iban}, account number 12345678"
    assert pii.masked(t, pii.find(t, anchors)) == "IBAN: [IBAN], account number [ACCOUNT]"


def test_cues_in_any_case():
    found = pii._automaton()

    def spans(t):
        return [(k, t[a:b]) for k, a, b in pii.find(t, found)]

    assert spans("Api_Key = abcd1234efgh5678") == [("secret", "abcd1234efgh5678")]
    assert spans("see Http://Example.com/x now") == [("url", "Http://Example.com/x")]
    assert spans("\u0130\u0130 pAsSwOrD: abcd1234efgh5678") == [("secret", "abcd1234efgh5678")]
    assert spans("ACCOUNT number 12345678") == spans("aCCount number 12345678") == [("account", "12345678")]
