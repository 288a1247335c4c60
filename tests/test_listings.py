"""CSV listings with quotes, line breaks and bad records; JSON classes."""

import json

import pytest

from vitrine.sources import listings as ls


def test_every_record_is_read_or_refused(spark, tmp_path):
    x = tmp_path / "x.csv"
    x.write_text('row_id,designation,description,productid,imageid\n'
                 '1,plain,"two\nlines, and a ""quote""",7,8\n'
                 '2,"  blanks  ",,7,8\n'
                 'abc,no number,d,7,8\n'
                 '3,too few\n'
                 '4,too,many,7,8,9\n'
                 ',no id,d,7,8\n'
                 '5,"é 中",""\n'
                 '6,only x,d,1,2\n')
    got = ls.read_csv(spark, str(x), ls.X_SCHEMA)
    rows = {r.row_id: (r.designation, r.description) for r in got.rows.collect()}
    assert rows == {1: ("plain", 'two\nlines, and a "quote"'), 2: ("  blanks  ", None), 6: ("only x", "d")}
    refused = [r.record for r in got.refused.collect()]
    assert len(refused) == 5 and any("abc" in r for r in refused) and any("no id" in r for r in refused)
    y = tmp_path / "y.csv"
    y.write_text("row_id,prdtypecode\n1,10\n2,40\n9,50\n1,\n")
    joined, _, labels = ls.load_labelled(spark, str(x), str(y))
    assert {(r.row_id, r.prdtypecode, r.text_raw) for r in joined.collect()} == {(1, 10, 'plain two\nlines, and a "quote"'), (2, 40, "blanks"), (1, None, 'plain two\nlines, and a "quote"')}
    assert labels.rows.count() + labels.refused.count() == 4


def test_empty_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text("row_id,prdtypecode\n")
    got = ls.read_csv(spark, str(tmp_path / "e.csv"), ls.Y_SCHEMA)
    assert got.rows.count() == got.refused.count() == 0


def test_written_listings_come_back(spark, tmp_path):
    rows = [(1, 'a "b", c', "x\ny", None, 5), (2, "", None, 3, None), (3, " lead", "tail ", None, None), (4, "back\\slash", '"', 1, 1)]
    df = spark.createDataFrame(rows, ls.X_SCHEMA)
    ls.write_csv(df, f"{tmp_path}/w")
    got = ls.read_csv(spark, f"{tmp_path}/w", ls.X_SCHEMA)
    assert sorted(map(tuple, got.rows.collect())) == rows and got.refused.count() == 0


def test_classes_keep_their_order(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"name": "n", "classes": [40, 10, 2905]}, indent=1))
    assert sorted(map(tuple, ls.read_classes(spark, str(tmp_path / "c.json")).collect())) == [(0, 40), (1, 10), (2, 2905)]
    (tmp_path / "d.json").write_text('{"other": 1}')
    with pytest.raises(Exception, match="no classes array"):
        ls.read_classes(spark, str(tmp_path / "d.json")).collect()
