"""Files with line breaks in quotes, parsed by range, against Spark's reader in one task."""

import random

import pytest

from conftest import rows
from lakestrata.sources import files, quoted

_FIELDS = ['"a"', '""', "", '"line\nbreak"', '"two\n\n breaks"', '"say ""hi"""', 'odd"quote', '"x,y"', " spaced ", '"""\n"""', "é日本", '"\n"', '"end"tail', "'", '"\\"']


@pytest.fixture
def cut_at(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield to
    for k, v in kept.items():
        spark.conf.set(k, v)


def _file(tmp_path, seed, n, end="\n", header=True, last=True):
    rng = random.Random(seed)
    body = [",".join(rng.choices(_FIELDS, k=3)) for _ in range(n)]
    body = [x for x in body if x != ",,"] + ["x,,"]
    text = "\n".join((["a,b,c"] if header else []) + body) + ("\n" if last else "")
    path = tmp_path / f"f{seed}.csv"
    path.write_bytes(text.replace("\n", end).encode())
    return str(path)


@pytest.mark.parametrize("seed,end,header,last", [(1, "\n", True, True), (2, "\r\n", True, True), (3, "\n", False, False), (4, "\r\n", True, False)])
def test_every_cut_gives_the_rows_of_one_task(spark, tmp_path, cut_at, seed, end, header, last):
    path, config = _file(tmp_path, seed, 7, end, header, last), {"header": header}
    options = files.csv_options(config)
    want = rows(spark.read.options(**options).schema(files.text_schema(["a", "b", "c"])).csv(path))
    for size in (1, 2, 3, 5, 8, 13, 21, 34, 1000):  # at 1 each byte is a cut
        cut_at(size)
        got = quoted.read_quoted(spark, path, files.text_schema(["a", "b", "c"]), options, header)
        assert rows(got) == want, size


def test_large_files_are_split_and_small_ones_are_not(spark, tmp_path, cut_at):
    for seed in (7, 8):
        _file(tmp_path, seed, 3000)
    path = str(tmp_path)
    want = rows(files.read_csv(spark, path, ["a", "b", "c"], {}))
    assert not files.splittable(spark, path, {})
    cut_at(4096)
    assert files.splittable(spark, path, {}) and not files.splittable(spark, path, {"compression_type": "gzip"}) and not files.splittable(spark, path, {"multi_line": False})
    got = files.read_csv(spark, path, ["a", "b", "c"], {})
    assert rows(got) == want and got.rdd.getNumPartitions() > 4
    assert rows(files.read_csv(spark, path, None, {})) == want


def test_a_field_over_many_ranges(spark, tmp_path, cut_at):
    path = tmp_path / "long.csv"
    path.write_text('a,b\n1,"' + "text, with\nbreaks " * 300 + '"\n2,"x"\n3,"never closed\n' + "more\n" * 50 + "end")
    want = rows(spark.read.options(**files.csv_options({"mode": "PERMISSIVE"})).schema("a string, b string").csv(str(path)))
    cut_at(100)
    got = rows(files.read_csv(spark, str(path), ["a", "b"], {"mode": "PERMISSIVE"}))
    assert got == want and len(got) == 3


def test_swapped_header_fails_in_every_file(spark, tmp_path, cut_at):
    _file(tmp_path, 1, 50)
    (tmp_path / "g.csv").write_text("b,a,c\n" + "1,2,3\n" * 50)
    cut_at(64)
    with pytest.raises(Exception, match="header does not name"):
        files.read_csv(spark, str(tmp_path), ["a", "b", "c"], {}).collect()


@pytest.mark.parametrize("pieces", [False, True])
def test_what_a_task_holds_is_bounded_by_bytes(pieces):
    import pyarrow as pa

    n = 3000
    batch = pa.RecordBatch.from_pydict({"file": ["f"] * n, "block": [0] * n, "inside": [False] * n, "value": [f"{i}," + "x" * 5000 for i in range(n)]})
    out = list(quoted._cut(",", pieces)(iter([batch])))
    assert [r for b in out for r in b.column("record").to_pylist()] == ([] if pieces else batch.column("value").to_pylist())
    assert max(b.nbytes for b in out) < 3 << 20
