"""Files that give nothing, elements chosen in pages, correlations of many columns."""

import gzip
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormspan.operators import stats
from stormspan.sources import readers


def test_skipped_files_are_rows(spark, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    whole = b"t,v\n" + b"".join(b"%d,%d.5\n" % (i, i) for i in range(2000))
    (folder / "good.csv").write_bytes(whole)
    (folder / "good.csv.gz").write_bytes(gzip.compress(whole))
    (folder / "header.csv").write_bytes(b"t,v\n")
    (folder / "empty.csv").write_bytes(b"")
    (folder / "noise.csv.gz").write_bytes(b"this is no gzip stream")
    (folder / "gone.csv").write_bytes(whole)
    inventory = readers.file_inventory(spark, str(folder), str(tmp_path / "inventory"))
    rows = readers.read_csv(spark, str(folder), "t int, v double", skip_bad=True)
    os.remove(folder / "gone.csv")
    read = rows.select("_metadata.file_path", "t", "v")
    assert read.count() == 4000
    found = readers.skipped_files(spark, inventory, str(folder), read).collect()
    assert {(os.path.basename(r.path), r.reason) for r in found} == {
        ("header.csv", "no readable row"), ("noise.csv.gz", "no readable row"), ("gone.csv", "vanished"),
    }
    assert len(found) == 3 and all(r.length > 0 for r in found)


def test_broken_gzip_files_have_reasons(spark, tmp_path):
    data = np.random.default_rng(1).bytes(3_000_000)
    one = gzip.compress(data)
    files = {
        "whole": one, "two": one + gzip.compress(b"more"), "padded": one + bytes(512), "cut": one[:-2000], "tail": one[:-4],
        "flipped": one[:-8] + bytes(8), "noise": b"no gzip", "none": b"", "second": one + b"rest",
    }
    for name, content in files.items():
        (tmp_path / f"{name}.gz").write_bytes(content)
    found = readers.broken_gzip(readers.read_binary(spark, str(tmp_path))).collect()
    assert {os.path.basename(r.path)[:-3] for r in found} == {"cut", "tail", "flipped", "noise", "second"}
    reasons = {os.path.basename(r.path)[:-3]: r.reason for r in found}
    assert (reasons["cut"], reasons["tail"]) == ("breaks off", "breaks off")


PAGE = """<html><TABLE><tr valign="top"><td><div>layout</div>
<table border=0 cols=9><tr valign='top'><td><div> A &amp; B </div></td><td><div><table cols="2"><tr valign="top"><td>
<div>inner</div></td></tr></table ></div></td></tr><tr><td><div>head</div></td></tr>
<tr valign="top"><td><div>2</div></td></tr></table></td></tr></TABLE>
<tablex cols=9>no</tablex><table cols="9"><tr valign="top"><td><div>second</div></table>
<table cols="99"><tr valign="top"><td><div>other</div></td></tr></table><table data-cols="9">x</table>
<table cols='9'><tr valign="top"><td><div>open</div></td></tr>"""


def test_tables_are_chosen_by_attribute(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p>no table</p>")], "id int, html string")
    found = readers.html_elements(pages, "html", "table", "cols", "9", "chosen").drop("html").collect()
    assert [(r.id, r.element_no) for r in found] == [(1, 0), (1, 1), (1, 2)]
    first, second, last = (r.chosen for r in found)
    assert "inner" not in first and "layout" not in first and first.startswith("<table border=0 cols=9>")
    assert "second" in second and "open" in last
    chosen = readers.html_elements(pages, "html", "table", "cols", "9", "chosen").filter("element_no = 0")
    rows = readers.html_rows(chosen, "chosen", readers.TABLE_ROW, readers.TABLE_CELL).orderBy("row_no").collect()
    assert [r.cells for r in rows] == [["A & B", ""], ["2"]]
    whole = readers.html_elements(pages, "html", "table", "cols", "9", nested=True).collect()
    assert "inner" in whole[0].element and whole[0].element.endswith("</table>")
    outer = readers.html_elements(pages, "html", "table", "cols", "2").collect()
    assert len(outer) == 1 and "inner" in outer[0].element


def test_correlation_matrix_equals_pairwise(spark):
    rng = np.random.default_rng(3)
    size = 100
    base = rng.normal(size=(400, 6)) @ rng.normal(size=(6, size)) + rng.normal(size=(400, size)) + 1e6
    base[:, 7] = 3.25
    missing = rng.random(base.shape) < 0.1
    names = [f"v{i}" for i in range(size)]
    rows = [[None if m else float(x) for x, m in zip(r, k)] for r, k in zip(base, missing)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = {(r.column_a, r.column_b): r.r for r in stats.correlation_matrix(df, names).collect()}
    assert len(got) == size * (size - 1) // 2
    for i in range(size):
        for j in range(i + 1, size):
            both = ~missing[:, i] & ~missing[:, j]
            r = got[names[i], names[j]]
            if 7 in (i, j):
                assert r is None
            else:
                assert r == pytest.approx(np.corrcoef(base[both, i], base[both, j])[0, 1], abs=1e-9)
    pairs = {(r.column_a, r.column_b): r.r for r in stats.correlations(df, names[:5]).collect()}
    assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in pairs.items())
    assert all(r.r is None for r in stats.correlation_matrix(df.limit(0), names[:3]).collect())
    odd = df.select("v0", F.when(F.col("v1") > 1e6, float("nan")).otherwise(F.col("v1")).alias("v1"))
    clean = df.select("v0", F.when(F.col("v1") > 1e6, None).otherwise(F.col("v1")).alias("v1"))
    assert stats.correlation_matrix(odd, ["v0", "v1"]).first().r == stats.correlation_matrix(clean, ["v0", "v1"]).first().r


def test_one_document_of_features_is_read_by_several_tasks(spark, tmp_path):
    def written(i):
        shape = {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i + 1, 1.5], [i, 0]]]}
        return {"type": "Feature", "properties": {"id": f"zöne, {i} {{}}]", "size": i}, "geometry": shape}

    path = tmp_path / "zones.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "name": "zones", "features": [written(i) for i in range(3000)]}, ensure_ascii=False))
    start = '{"type": "Feature",'
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = readers.read_polygons(spark, str(path), start=start)
        assert split.rdd.getNumPartitions() > 4
        rows = split.orderBy("pos").collect()
        sizes = readers.read_feature_properties(spark, str(path), "id: string, size: int", start=start).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = readers.read_polygons(spark, str(path)).orderBy("pos").collect()
    assert [(r.zone, r.parts) for r in rows] == [(r.zone, r.parts) for r in whole]
    assert sorted(r.size for r in sizes) == list(range(3000)) and sizes[0].id.startswith("zöne")
    none = tmp_path / "none.json"
    none.write_text('{"type": "FeatureCollection", "features": []}')
    assert readers.read_polygons(spark, str(none), start=start).count() == 0
    broken = tmp_path / "broken.json"
    broken.write_text('{"features": [' + start + ' "geometry": {"type": }]}')
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_polygons(spark, str(broken), start=start).collect()
