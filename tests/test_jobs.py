import math

import pytest

from clickfeat.__main__ import _parser
from clickfeat.plans import jobs

HEADER = "Id,Label,I1,I2,C1,C2"


def read(path):
    return sorted(
        line for part in path.glob("part-*") for line in part.read_text().splitlines()
    )


@pytest.fixture()
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [
        f"{i},{i % 3 % 2},{'' if i % 5 == 0 else i % 7},{i % 4},{i % 3:x},{i % 20 + 10:x}"
        for i in range(300)
    ]
    for part in range(2):
        text = "\n".join([HEADER, *lines[part::2]])
        (folder / f"part-{part}").write_text(text + "\n")
    return str(folder)


def test_summary_then_vw(spark, source, tmp_path):
    saved = jobs.summarise_csv(spark, source, str(tmp_path / "summary"))
    assert saved.count() == 5
    jobs.csv_to_vw(spark, source, str(tmp_path / "a"), files=1)
    jobs.csv_to_vw(spark, source, str(tmp_path / "b"), saved_summary=str(tmp_path / "summary"))
    assert len(list((tmp_path / "a").glob("part-*"))) == 1
    lines = read(tmp_path / "a")
    assert lines == read(tmp_path / "b") and len(lines) == 300
    # Id 2: label 0 (2 % 3 % 2), I1 and I2 are 2 of at most 6 and 3.
    [line] = [line for line in lines if line.startswith("-1.0 '2 ")]
    numbers, levels = line.removeprefix("-1.0 '2 |Num ").split(" |Cats ")
    assert levels == "_2 _12"
    (name1, value1), (name2, value2) = (pair.split(":") for pair in numbers.split(" "))
    assert (name1, name2) == ("I1", "I2")
    assert float(value1) == pytest.approx(math.log(3) / math.log(7))
    assert float(value2) == pytest.approx(math.log(3) / math.log(4))


def test_sparse_text(spark, source, tmp_path):
    size = jobs.csv_to_sparse_text(spark, source, str(tmp_path / "tr"), str(tmp_path / "te"))
    assert size == 3  # only C1 has levels with more than 15 rows
    train, test = read(tmp_path / "tr"), read(tmp_path / "te")
    assert len(train) + len(test) == 300 and len(train) > len(test) > 0
    assert all(line.split(" | ")[0] in ("1", "-1") for line in train + test)


def test_target_encoding_chain(spark, source, tmp_path):
    rates, state, encoded, filled = (str(tmp_path / n) for n in ("rates", "state", "enc", "fill"))
    jobs.fit_target_rates(spark, source, rates, state)
    assert "4,1,1.0" in read(tmp_path / "rates") and "4,0,0.0" in read(tmp_path / "rates")
    jobs.apply_target_rates(spark, source, state, encoded)
    assert "5.0,0.0,null,1.0,0.0,0.3333333333333333" in read(tmp_path / "enc")
    jobs.fill_means(spark, encoded, filled)
    assert not any("null" in line for line in read(tmp_path / "fill"))
    jobs.encode_and_fill(spark, source, str(tmp_path / "all"), str(tmp_path / "all-rates"))
    assert read(tmp_path / "all") == read(tmp_path / "fill")
    assert read(tmp_path / "all-rates") == read(tmp_path / "rates")


def test_imputer_chain(spark, source, tmp_path):
    jobs.fit_imputer(spark, source, str(tmp_path / "state"))
    jobs.apply_imputer(spark, source, str(tmp_path / "state"), str(tmp_path / "out"))
    lines = read(tmp_path / "out")
    present = [i % 7 for i in range(300) if i % 5]
    assert f"5,0,{sum(present) / len(present)},1,2,15" in lines
    assert "1,1,1,1,1,11" in lines


def test_split_lines(spark, source, tmp_path):
    jobs.split_lines(spark, source, str(tmp_path / "x_1"), str(tmp_path / "x_2"))
    one, two = read(tmp_path / "x_1"), read(tmp_path / "x_2")
    assert len(one) + len(two) == 300 and len(set(one) | set(two)) == 300
    jobs.split_lines(spark, source, str(tmp_path / "y_1"), str(tmp_path / "y_2"), files=1)
    assert len(list((tmp_path / "y_1").glob("part-*"))) == 1
    assert read(tmp_path / "y_1") == one


def test_mean_fill_keeps_every_field_of_ragged_lines(spark, tmp_path):
    (tmp_path / "in").write_text("1,2\n3,null,5\n5,4,7,9\n")
    jobs.fill_means(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    lines = read(tmp_path / "out")
    assert "5.0,4.0,7.0,9.0" in lines and all(line.count(",") == 3 for line in lines)


def test_a_saved_summary_without_a_column_is_refused(spark, source, tmp_path):
    jobs.summarise_csv(spark, source, str(tmp_path / "summary"))
    short = spark.read.parquet(str(tmp_path / "summary")).filter("col <> 'I1'")
    short.write.parquet(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="statistics"):
        jobs.csv_to_vw(spark, source, str(tmp_path / "vw"), str(tmp_path / "short"))


def test_training_jobs(spark, source, tmp_path):
    parts = {r["part"]: r for r in jobs.train_and_score(spark, source).collect()}
    assert parts["train"]["rows"] + parts["test"]["rows"] == 300
    assert all(0 < r["loss"] < 1 for r in parts.values())
    model, curve = jobs.train_dictionary(spark, source)
    assert model.numFeatures == 2 + 3 + 20
    assert {r["threshold"] for r in curve.collect()} == {0.0, 1.0}  # C1 decides the label
    model, curve = jobs.train_hashed(spark, source, bits=8)
    assert model.numFeatures == 30 + 256 and curve.count() == 2
    assert jobs.train_indexed(spark, source).first()["loss"] < 0.3
    dense = tmp_path / "dense.csv"
    dense.write_text("\n".join(f"{i % 2},{i % 2 + i / 100},{i % 5}" for i in range(60)))
    assert jobs.train_dense(spark, str(dense), str(dense)).first()["loss"] < 0.3


def test_naive_bayes_and_levels(spark, source, tmp_path):
    jobs.naive_bayes_scores(spark, source, str(tmp_path / "nb"), pool_below=2, threshold=0.5)
    ids = {int(line.split(",")[0]) for line in read(tmp_path / "nb")}
    # Ids are read as hex; the label is 1 exactly where C1 is 1.
    assert ids == {int(str(i), 16) for i in range(300) if i % 3 == 1}
    levels = {r["col"]: r["levels"] for r in jobs.count_levels(spark, source).collect()}
    assert levels == {"C1": 3, "C2": 20}


def test_command_line():
    args = _parser().parse_args(["csv-to-vw", "in", "out", "--files", "1"])
    assert (args.job, args.source, args.out, args.files) == ("csv-to-vw", "in", "out", 1)
