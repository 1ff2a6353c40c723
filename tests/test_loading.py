"""CSV files with bad lines set aside."""

import datetime as dt

import pytest

from cohortlens.sources import tables

SCHEMA = "id long, day date, note string"


def load(spark, tmp_path, text, name="a", **more):
    (tmp_path / f"{name}.csv").write_text(text)
    return tables.load_csv(spark, str(tmp_path / f"{name}.csv"), SCHEMA, str(tmp_path / f"{name}_out"), **more)


def test_bad_lines_go_whole_and_are_counted(spark, tmp_path):
    loaded = load(
        spark, tmp_path, 'note,id,day,more\n"a, b",1,2020-01-02,x\nc,two,2020-13-01,y\n,3,2020-01-04,\nd,4\ne,5,,z,too,many\nf,6,,\n',
        columns_needed=["note"],
    )
    assert sorted(tuple(r) for r in loaded.rows.collect()) == [(1, dt.date(2020, 1, 2), "a, b"), (6, None, "f")]
    got = {r.line: r.bad_columns for r in loaded.rejects.collect()}
    assert got.pop("d,4") == [] and got.pop("e,5,,z,too,many") == []
    assert sorted(got.values()) == [["id", "day"], ["note"]]
    assert any(line.startswith("c,two,2020-13-01") for line in got)
    assert loaded.counts == {"n_rows": 6, "n_rejected": 4, "n_malformed": 2, "id": 1, "day": 1, "note": 1}
    assert loaded.rejects.filter("file LIKE '%a.csv'").count() == 4


def test_without_lines_or_columns(spark, tmp_path):
    loaded = load(spark, tmp_path, "id,day,note\n", "none")
    assert loaded.rows.count() == 0 and loaded.rejects.count() == 0 and set(loaded.counts.values()) == {0}
    with pytest.raises(ValueError, match="note"):
        load(spark, tmp_path, "id,day\n1,2020-01-01\n", "short")
