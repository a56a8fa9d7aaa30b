from __future__ import annotations

import random
import re

from corpuscope.llm import secrets as S

ASSIGN = re.compile("(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


def test_base_rules_against_plain_patterns():
    rng = random.Random(6)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "0123456789abcdef" * 2, "AKIA", "ABCDEFGH12345678",
             "token=token=", "é🎉", "ſecret=abcdefgh", "toKen=abcdefg", "\n", "x", "short", "deadbeef"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert S.find(text, S.BASE_RULES) == brute(text), repr(text)


def test_added_rules_leave_base_spans():
    text = "-----BEGIN RSA PRIVATE KEY----- token: ghp_" + "zQ" * 20 + " xoxb-1234567890-abc"
    kinds = [k for k, _, _ in S.find(text)]
    assert kinds == ["key_block", "assign", "forge", "chat"]
    assert [s for s in S.find(text) if s[0] in ("assign", "access", "hex")] == S.find(text, S.BASE_RULES)


def test_only_unseen_blobs_are_scanned(spark, documents):
    ledger = S.Ledger(spark)
    first = documents([(1, "token=abcdefgh"), (2, "clean text"), (3, "token=abcdefgh"), (4, None)])
    found = {r.row.doc_id: [tuple(s) for s in r.spans] for r in S.scan(first, ledger).collect()}
    assert found == {1: [("assign", 0, 14)], 2: [], 3: [("assign", 0, 14)], 4: []}
    assert ledger.table().count() == 3  # one row for each blob, the empty one too
    second = documents([(5, "clean text"), (6, "a new text"), (7, "token=abcdefgh")])
    assert {r.row.doc_id: len(r.spans) for r in S.scan(second, ledger).collect()} == {5: 0, 6: 0, 7: 1}
    assert ledger.table().count() == 4
    S.scan(second, ledger).count()
    assert ledger.table().count() == 4
    S.scan(second, ledger, rules=S.BASE_RULES, rule_version="base").count()
    assert ledger.table().filter("rule_version = 'base'").count() == 3


def test_a_lost_batch_is_scanned_again(spark, documents, tmp_path):
    ledger = S.Ledger(spark, f"file://{tmp_path}/ledger")
    docs = documents([(1, "token=abcdefgh")])
    S.scan(docs, ledger).count()
    next((tmp_path / "ledger").glob("batch-*/_SUCCESS")).unlink()
    assert ledger.table().count() == 0
    assert S.scan(docs, S.Ledger(spark, f"file://{tmp_path}/ledger")).first().spans[0].kind == "assign"


def test_odd_and_empty_tables(spark, odd, none):
    rows = S.scan(odd, S.Ledger(spark)).collect()
    assert len(rows) == 9 and all(not r.spans for r in rows)
    assert S.scan(none, S.Ledger(spark)).count() == 0
