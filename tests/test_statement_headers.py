"""Statement files whose headers differ: one plan, whatever their number."""

import random

import pytest
from pyspark.errors import AnalysisException

from ledgerloom.sources import statements


def write(folder, headers, files):
    folder.mkdir()
    rnd, want = random.Random(3), []
    for i in range(files):
        names = headers[i % len(headers)]
        lines = [",".join(names)]
        for j in range(3):
            row = {"description": f'"d{i}, {j}"', "amount": f"{i}.5", "Balance": "", "date": "2024-07-01"}
            lines.append(",".join(row.get(n, f"x{rnd.randrange(9)}") for n in names))
            want.append((f"d{i}, {j}", float(f"{i}.5"), "2024-07-01" if "date" in names else ""))
        (folder / f"f{i:04}.csv").write_text("\n".join(lines) + "\n")
    return sorted(want)


def headers(n):
    rnd = random.Random(n)
    out = []
    for i in range(n):
        names = ["description", "amount", "Balance", "date", f"extra{i}"]
        if i % 5 == 4:
            names[3] = f"when{i}"
        rnd.shuffle(names)
        out.append(names)
    return out


def test_many_headers_are_one_plan(spark, tmp_path):
    sizes = []
    for n, files in ((2, 20), (60, 240)):
        want = write(tmp_path / str(n), headers(n), files)
        df = statements.read_statement_csv(spark, str(tmp_path / str(n)))
        sizes.append(df._jdf.queryExecution().optimizedPlan().toString().count("\n"))
        assert sorted((r.description, float(r.amount), r.date) for r in df.collect()) == want
    assert sizes[0] == sizes[1]


def test_joined_headers_equal_broadcast_ones(spark, tmp_path, monkeypatch):
    want = write(tmp_path / "in", headers(7), 30)
    monkeypatch.setattr(statements, "BROADCAST_BYTES", -1)
    assert sorted((r.description, float(r.amount), r.date) for r in statements.read_statement_csv(spark, str(tmp_path / "in")).collect()) == want


def test_paths_that_do_not_exist_are_errors(spark, tmp_path):
    for read in (statements.read_statement_csv, statements.read_card_csv, statements.read_statements, lambda s, p: statements.read_categorised(s, p)[0]):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            read(spark, str(tmp_path / "no" / "such")).count()
    (tmp_path / "empty").mkdir()
    assert statements.read_statement_csv(spark, str(tmp_path / "empty")).count() == 0
    (tmp_path / "empty" / "a.csv").write_text("\n\n")
    assert statements.read_statement_csv(spark, str(tmp_path / "empty")).count() == 0


def test_names_and_widths(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\nDESCRIPTION,Amount,amount\nx,1,2,3,4\ny\n\n \"q\"\"uote\" ,5,\n")
    (tmp_path / "b.csv").write_text("amount,description,description\n7,first,second\n")
    (tmp_path / "c.csv").write_text("description,amount\r\ncr,8\r\n")
    got = sorted((r.description, float(r.amount)) for r in statements.read_statement_csv(spark, str(tmp_path)).collect())
    assert got == sorted([("x", 2.0), ("y", 0.0), (' "q""uote" ', 0.0), ("first", 7.0), ("cr", 8.0)])
