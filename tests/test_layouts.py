"""Landed layouts: one indented document per file, indented listings; unparsed input raises."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sparksignal import schemas
from sparksignal.functions import text
from sparksignal.operators import clean
from sparksignal.sources import files


def test_one_indented_document_per_file(spark, tmp_path):
    for day in ("2025-06-03", "2025-06-04"):
        doc = {"date": day, "prediction": "Up", "prediction_numeric": 1, "confidence": 0.61,
               "features": {"price_delta": 0.5}}
        (tmp_path / f"{day}.json").write_text(json.dumps(doc, indent=2))
        (tmp_path / f"war_exit_{day}.json").write_text(json.dumps({"date": day, "pressure": 1}, indent=2))
    got = files.read_json_documents(spark, str(tmp_path), schemas.PREDICTION, one_per_file=True)
    assert sorted(r["date"] for r in got.collect()) == ["2025-06-03", "2025-06-04"]
    assert {r["confidence"] for r in got.collect()} == {0.61}


def test_indented_documents_read_as_lines_raise(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"date": "2025-06-03"}, indent=2))
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        files.read_json_documents(spark, str(tmp_path), schemas.PREDICTION, exclude_kind=None).collect()


def test_indented_listing(spark, tmp_path):
    post = {"kind": "t3", "data": {"subreddit": "oil", "title": "Oil up", "selftext": "", "score": 3,
                                   "created_utc": 1.0}}
    page = {"kind": "Listing", "data": {"after": None, "children": [post, post]}}
    (tmp_path / "page.json").write_text(json.dumps(page, indent=2))
    assert files.read_listings(spark, str(tmp_path), one_per_file=True).count() == 2
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        files.read_listings(spark, str(tmp_path)).collect()


def test_white_space_around_titles_is_one_key(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["Oil up\n", "\tOil up", "OIL UP"])],
                               "entry_ord int, title string").withColumn("feed_ord", F.lit(0))
    assert [r["entry_ord"] for r in clean.first_seen(df).collect()] == [0]


@pytest.mark.parametrize("stamp, day", [
    ("03 Jun 25", "2025-06-03"), ("06-Nov-94", "1994-11-06"), ("03 June 2025", "2025-06-03"),
    ("Tue, 3 jun 2025 23:10:00 -0400", "2025-06-03"), ("Tuesday, 03-Jun-25 08:00:00 GMT", "2025-06-03"),
    ("31 Feb 2025", None), ("junk", None), (None, None)])
def test_feed_stamps(spark, stamp, day):
    got = spark.createDataFrame([(stamp,)], "s string").select(text.rfc822_date("s").alias("d"))
    assert str(got.first()["d"]) == str(day)
