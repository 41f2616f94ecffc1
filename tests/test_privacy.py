import hashlib
import re

import pytest

from vireo import config as C
from vireo.operators import privacy as S


@pytest.mark.parametrize("text,kind", [
    ("CPF: 123.456.789-00", "cpf"), ("CPF: 12345678900", "cpf"), ("mail test@example.com", "email"),
    ("Tel: (11) 98765-4321", "phone"), ("CEP: 01234-567", "cep"),
])
def test_scan_detects(spark, text, kind):
    df = spark.createDataFrame([(text,)], "t string")
    hit = {r.pattern: r.rows_matched for r in S.pii_scan(df, ["t"]).collect()}
    assert hit[kind] == 1
    safe = spark.createDataFrame([("nothing to see here",)], "t string")
    assert all(r.rows_matched == 0 for r in S.pii_scan(safe, ["t"]).collect())


def test_redaction_leaves_no_match(spark):
    texts = ["CPF: 123.456.789-00 and a@b.co", "Tel: (11) 98765-4321", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r.t for r in S.redact_columns(df, ["t"]).collect()]
    assert out[2] == "plain" and out[1] == "Tel: ([REDACTED]"
    for o in out:
        for _, pat in C.PII_PATTERNS[:2]:
            assert not re.search(pat, o)


def test_pseudonymize_matches_sha256(spark):
    df = spark.createDataFrame([(123,)], "k long")
    got = S.pseudonymize_columns(df, ["k"], "s").first().k
    assert got == hashlib.sha256(b"s:123").hexdigest()[:16]


def test_sanitize_nested(spark):
    df = spark.createDataFrame([(1, "Ana", ("x@y.com", 3), "fone 11987654321")],
                               "id int, nome string, meta struct<email:string,n:int>, note string")
    r = S.sanitize(df).first()
    assert r.nome == "[REDACTED]" and r.meta.email == "[REDACTED]" and r.meta.n == 3
    assert "[REDACTED]" in r.note and r.id == "[REDACTED]"
    only = S.sanitize(df.withColumnRenamed("id", "idade"), safe_only=True)
    assert only.columns == ["idade"]


def test_retention(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00", "old"), ("2024-03-01T00:00:00", "new"), (None, "x"),
                                ("garbage", "y")], "timestamp string, data string")
    r = S.retention_report(df, "timestamp", "2024-03-02", 30).first()
    assert (r.total, r.removed, r.retained) == (4, 1, 3)
