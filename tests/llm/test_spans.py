"""PII and secrets against the patterns of their contracts, applied plainly."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from shopgrain.llm import pii, queries, secret_scan
from shopgrain.operators.checkpoints import new_path


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain_pii(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, f"email:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, f"ip:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, f"card:{m.start()}:{m.end()}"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, f"phone:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def plain_secrets(text):
    out = []
    assign = r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text):
        if len(m[2]) >= 8 and m[1].isascii():
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 32:
            out.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def base(spans, kinds):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in spans if s["kind"] in kinds]


PIECES = st.lists(
    st.sampled_from(
        ["a@b.c", "@", ".", "x.y@z-1.de.", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "37828224631000", "-", " ",
         "+49 (0)30 1234567", "+", "é", "0", "12", "(", "😀", "DE89 3704 0044 0532 0130 00", "..", "078-05-1120 ssn"]
    ),
    max_size=14,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(PIECES)
def test_base_pii_is_that_of_the_patterns(text):
    assert base(pii.find_pii(text), pii.BASE) == plain_pii(text)


SECRETS = st.lists(
    st.sampled_from(
        ["password", "toKEN", "api_key", "apikey", "secret", "'", '"', " ", ":", "=", "abcdefgh", "abc", "AKIA",
         "AKIAABCDEFGHIJKL", "0123456789abcdef", "ſecret", "é", "\n", "-----BEGIN RSA PRIVATE KEY-----"]
    ),
    max_size=14,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(SECRETS)
def test_base_secrets_are_those_of_the_patterns(text):
    found = secret_scan.find_secrets(text, secret_scan.RULES, {r.key for r in secret_scan.RULES})
    found.sort(key=lambda s: (s["start"], s["rank"]))
    assert base(found, {r.kind for r in secret_scan.BASE_RULES}) == plain_secrets(text)


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")
    kinds = lambda t: [s["kind"] for s in pii.find_pii(t)]
    assert kinds("iban DE89 3704 0044 0532 0130 00 ") == ["iban"]
    assert kinds("DE88 3704 0044 0532 0130 00") == []
    assert kinds("078-05-1120") == [] and kinds("My social security number: 123-45-6789") == []
    assert pii.score("card 4111111111111111", "card", 5, 21) > pii.score("x 4111111111111111", "card", 2, 18)


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000, "a" * 200_000 + "@", "1" * 400_000, "1." * 200_000, "+1" + "(" * 400_000, "@" * 400_000, "eyJ" * 130_000, "DE89 " * 80_000, "DE89" * 100_000):
        pii.find_pii(text)
        secret_scan.find_secrets(text, secret_scan.RULES, {r.key for r in secret_scan.RULES})


def test_context_is_whole_words():
    ip = "10.0.0.1"
    assert pii.score(f"shipping {ip}", "ip", 9, 17) == pii.PRIOR["ip"]
    assert pii.score(f"ip {ip}", "ip", 3, 11) > pii.PRIOR["ip"] and pii.score(f"Serveur: {ip}", "ip", 9, 17) > pii.PRIOR["ip"]
    assert pii.score(f"the latest {ip}", "ip", 11, 19) == pii.PRIOR["ip"] > pii.score(f"a test {ip}", "ip", 7, 15)
    assert pii.score("hotel +49 30 123456", "phone", 6, 19) == pii.PRIOR["phone"]


def test_account_numbers_end_where_their_country_says():
    code = "ES91 2100 0418 4502 0005 1332"
    for behind in ("", " IN", " AND more", ".", " 12"):
        found = [(s["start"], s["end"]) for s in pii.find_pii(f"x {code}{behind}") if s["kind"] == "iban"]
        assert found == [(2, 2 + len(code))], behind
    for wrong in (code + "1", code[:-1], code.replace("ES", "DE"), code.replace("91", "92"), "ZZ91 2100 0418 4502 0005 1332"):
        assert not [s for s in pii.find_pii(wrong) if s["kind"] == "iban"]


def test_web_tokens():
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NSJ9.abcdefghij_-0123"
    found = [s for s in secret_scan.find_secrets(f"a {token}.", secret_scan.RULES, {r.key for r in secret_scan.RULES}) if s["kind"] == "jwt"]
    assert [(s["start"], s["end"]) for s in found] == [(2, 2 + len(token))]


def test_queries_on_whole_documents(spark, sf_dir, texts):
    for query, plain in ((queries.op3_pii, plain_pii), (queries.op10_secrets, plain_secrets)):
        got = {r["doc_id"]: r for r in query(spark, sf_dir).collect()}
        assert len(got) == len(texts)
        for doc_id, text, _ in texts:
            want = plain(text or "")
            r = got[doc_id]
            assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
            for c in [c for c in r.asDict() if c.startswith("n_")]:
                assert r[c] == sum(s.startswith(c[2:] + ":") for s in want)


def test_edge_rows(spark, rows):
    data = [(1, None), (2, ""), (2, ""), (None, "mail a@b.co"), (3, "token=abcdefghij " * 3000)]
    for table in (rows("doc_id long, text string", data), rows("doc_id long, text string", [])):
        found = pii.detect(table).collect()
        assert sorted(len(r["pii"]) for r in found) == ([0, 0, 0, 0, 1] if found else [])
        scanned = secret_scan.scan_versions(table, new_path(spark, "ledger"))
        assert set(table.columns) <= set(scanned.columns)
        assert sorted(len(r["findings"]) for r in scanned.collect()) == ([0, 0, 0, 0, 3000] if found else [])


def test_ledger_scans_each_blob_once_per_rule_version(spark, monkeypatch):
    ledger = new_path(spark, "ledger")
    one = spark.createDataFrame([("a/x", "token=abcdefghij"), ("b/x", "token=abcdefghij"), ("c", "AKIA0123456789AB")], "path string, text string")
    first = secret_scan.scan_versions(one, ledger)
    assert {r["path"]: [s["kind"] for s in r["findings"]] for r in first.collect()} == {"a/x": ["assign"], "b/x": ["assign"], "c": ["access"]}
    assert secret_scan.read_ledger(spark, ledger).count() == 2
    more = one.union(spark.createDataFrame([("d", "token=abcdefghij"), ("e", "x")], one.schema))
    second = {r["path"]: len(r["findings"]) for r in secret_scan.scan_versions(more, ledger).collect()}
    assert second == {"a/x": 1, "b/x": 1, "c": 1, "d": 1, "e": 0}
    assert secret_scan.read_ledger(spark, ledger).count() == 3  # only the new blob was scanned
    rules = (*secret_scan.BASE_RULES[:2], secret_scan.Rule("hex", r"[0-9a-f]{4,}", 0, 4, version=2))
    third = {r["path"]: [s["kind"] for s in r["findings"]] for r in secret_scan.scan_versions(more, ledger, rules=rules).collect()}
    assert third["a/x"] == ["assign", "hex"] and third["e"] == []
    ran = secret_scan.read_ledger(spark, ledger).where("array_contains(rules, 'hex@2')").collect()
    assert len(ran) == 3 and all(r["rules"] == ["hex@2"] for r in ran)


def test_redaction(spark):
    df = spark.createDataFrame([("x token=abcdefghij y",), ("no",), (None,)], "text string")
    found = secret_scan.scan_versions(df, new_path(spark, "ledger"))
    got = found.select(secret_scan.redact(found["text"], found["findings"]).alias("t")).collect()
    assert {r["t"] for r in got} == {"x [secret] y", "no", None}
