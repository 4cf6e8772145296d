"""Values behind an assignment or a key word are candidates whatever their length and characters."""

import pyarrow as pa
import pytest

from ternion.llm import secrets


@pytest.fixture(scope="module")
def forest():
    return secrets.train()


@pytest.mark.parametrize("text,value", [("the password = correcthorsebattery now", "correcthorsebattery"), ("a secret: abcdefghijklmnop", "abcdefghijklmnop"), ("my pwd: hunter2xyz9 ok", "hunter2xyz9"), ("password: ab!cd#ef&12^x9", "ab!cd#ef&12^x9"), ('db_password="p w!9"', "p w!9")])
def test_candidates(text, value):
    assert value.encode() in [text.encode()[a:z] for _, a, z in secrets.candidates(pa.array([text]))]


def test_redaction(spark, forest):
    docs = spark.createDataFrame([(1, "the password = correcthorsebattery now", "s"), (2, "my pwd: hunter2xyz9 ok", "s"), (3, "the house: small and old", "s")], "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in secrets.redact(docs, forest).collect()}
    assert got == {1: "the password = [secret] now", 2: "my pwd: [secret] ok", 3: "the house: small and old"}
