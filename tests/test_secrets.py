from __future__ import annotations

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import crypto
from ledgermill.operators import secrets
from ledgermill.plans import catalogue
from ledgermill.plans.frames import SAMPLE_KEY, SAMPLE_SECRET
from tests.conftest import SF


def hidden_in(plan: str) -> list[str]:
    inner, outer = crypto.hmac_pads(SAMPLE_SECRET)
    wanted = [SAMPLE_SECRET, SAMPLE_KEY, inner, outer, SAMPLE_KEY.encode().hex()]
    return [w for w in wanted if w.lower() in plan.lower()]


@pytest.mark.parametrize("name", ["config_vars", "signed_links", "signed_actions", "checklist_answers"])
def test_no_plan_holds_the_secret(spark, name):
    found = catalogue.queries()[name](spark, SF)
    assert not hidden_in(found._jdf.queryExecution().toString())
    assert found.count() >= 0
    found.collect()
    assert not hidden_in(found._jdf.queryExecution().toString())


def test_a_literal_secret_would_be_seen(spark):
    literal = spark.range(1).select(crypto.review_token(F.col("id"), F.lit("confirm"), SAMPLE_SECRET))
    assert hidden_in(literal._jdf.queryExecution().toString())


def test_kept_secrets_sign_and_encrypt_alike(spark, folder):
    secrets.keep_secret(spark, f"{folder}/s", SAMPLE_SECRET)
    secrets.keep_secret(spark, f"{folder}/k", SAMPLE_KEY)
    pads = secrets.signing_pads(spark, f"{folder}/s")
    key = secrets.encryption_key(spark, f"{folder}/k")
    df = spark.range(3).select(
        "id", crypto.review_token(F.col("id"), F.lit("reject"), pads).alias("t"),
        crypto.decrypt(crypto.encrypt(F.col("id").cast("string"), key), key).alias("v"),
    )
    for r in df.collect():
        wanted = hmac.new(SAMPLE_SECRET.encode(), f"{r['id']}|reject".encode(), hashlib.sha256)
        assert r["t"] == wanted.hexdigest() and r["v"] == str(r["id"])
    with pytest.raises(ValueError, match="secret"):
        secrets.keep_secret(spark, f"{folder}/e", "")
