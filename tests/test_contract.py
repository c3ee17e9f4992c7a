import pytest
from pyspark.sql import types as T

from arrivo.sources.contract import ContractError, normalise_name, scan_contract

CONTRACT = {"Year": T.IntegerType(), "DepDelay": T.StringType(), "Cancelled": T.IntegerType()}


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_hand_case(spark, tmp_path):
    path = write(tmp_path, "f.csv", '"Year","Bogus-1",DepDelay,Cancelled\n'
                 "2008,q,NA,0\nNA,,5,0\n2008,x,,1\n2008,y,7\n2008,z,8,0,9\n")
    res = scan_contract(spark, path, CONTRACT, required=("Cancelled",))
    assert res.header == ("Year", "Bogus1", "DepDelay", "Cancelled")
    assert res.unknown_columns == ("Bogus1",)
    schema = {f.name: f.dataType for f in res.frame.schema.fields}
    assert schema == {"Year": T.IntegerType(), "Bogus1": T.StringType(),
                      "DepDelay": T.StringType(), "Cancelled": T.IntegerType()}
    rows = [tuple(r) for r in res.frame.collect()]
    assert rows == [(2008, "q", "NA", 0), (None, None, "5", 0), (2008, "x", None, 1),
                    (2008, "y", "7", None), (2008, "z", "8", 0)]


def test_normalise():
    assert normalise_name('"Bogus-1"') == "Bogus1"
    assert normalise_name(" Day of Month ") == "DayofMonth"


def test_case_insensitive_duplicates_rejected(spark, tmp_path):
    path = write(tmp_path, "d.csv", "Year,year,Cancelled\n1,2,0\n")
    with pytest.raises(ContractError):
        scan_contract(spark, path, CONTRACT, required=())


def test_extension_guard(spark, tmp_path):
    path = write(tmp_path, "f.CSV", "Year,Cancelled\n1,0\n")
    with pytest.raises(ContractError):
        scan_contract(spark, path, CONTRACT, required=())


def test_empty_and_headerless(spark, tmp_path):
    path = write(tmp_path, "e.csv", "Year,Cancelled\n")
    with pytest.raises(ContractError):
        scan_contract(spark, path, CONTRACT, required=())
    path = write(tmp_path, "n.csv", "")
    with pytest.raises(ContractError):
        scan_contract(spark, path, CONTRACT, required=())


def test_required_columns(spark, tmp_path):
    path = write(tmp_path, "r.csv", "Year,DepDelay\n1,2\n")
    with pytest.raises(ContractError):
        scan_contract(spark, path, CONTRACT, required=("Cancelled",))


def test_column_exists(spark):
    from arrivo.sources.contract import column_exists
    df = spark.createDataFrame([(1, 2)], "Year int, DepDelay int")
    assert column_exists(df, "year") and column_exists(df, "DEPDELAY")
    assert not column_exists(df, "Month")


def test_folder_with_mixed_headers_is_rejected(spark, tmp_path):
    folder = tmp_path / "mixed.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("Year,Cancelled,DepDelay\n2008,0,5\n")
    (folder / "b.csv").write_text("Cancelled,Year,DepDelay\n0,2008,9\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_contract(spark, str(folder), CONTRACT, required=()).frame.collect()


def test_inputs_in_any_column_order_are_aligned(spark, tmp_path):
    a = write(tmp_path, "a.csv", "Year,Cancelled,DepDelay\n2008,0,5\n")
    b = write(tmp_path, "b.csv", "Cancelled,Year,Dep-Delay\n1,2009,9\n")
    got = scan_contract(spark, [a, b], CONTRACT, required=("cancelled",)).frame
    assert sorted(tuple(r) for r in got.collect()) == [(2008, 0, "5"), (2009, 1, "9")]
    c = write(tmp_path, "c.csv", "Cancelled,Year\n1,2009\n")
    with pytest.raises(ContractError):
        scan_contract(spark, [a, c], CONTRACT, required=())


def test_dimension_folder_with_mixed_headers_is_rejected(spark, tmp_path):
    from arrivo.sources.dimension import read_dimension_csv
    from arrivo.sources.tables import DIMENSION_HEADER
    folder = tmp_path / "dim.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(",".join(DIMENSION_HEADER) + "\n" + ",".join("abcdefghi") + "\n")
    (folder / "b.csv").write_text(",".join(DIMENSION_HEADER[::-1]) + "\n" + ",".join("abcdefghi") + "\n")
    read = read_dimension_csv(spark, str(folder))
    with pytest.raises(Exception, match="(?i)header"):
        raise ValueError(read.reason) if read.frame is None else ValueError(read.frame.collect())


def test_rejects_are_counted_by_column(spark, tmp_path):
    from arrivo.sources.contract import scan_rejects
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("Year,Carrier,Distance,Cancelled,ArrDelay\n"
                "2008,AA,100,0,5\n"
                "20x8,AA,1.5,0,5\n"          # two bad values
                "2008,\"A,A\",far,0,\n"      # quoted comma, a bad value, an empty last field
                "2008,AA\n"                  # three fields missing
                "2008,AA,,0,5,6,7\n"         # two surplus fields; an empty one is no bad value
                "x,AA,1,0,5,6\n"             # surplus and bad
                "2008,,,,\n")
    got = {(r.column_name, r.reject): r.lines for r in scan_rejects(spark, path).collect()}
    assert got == {("Year", "bad_value"): 2, ("Distance", "bad_value"): 2, (None, "extra_field"): 2,
                   ("Distance", "missing_field"): 1, ("Cancelled", "missing_field"): 1, ("ArrDelay", "missing_field"): 1}
    frame = scan_contract(spark, path).frame
    assert frame.count() == 7 and frame.filter("Distance is null").count() == 5
    clean = str(tmp_path / "clean.csv")
    with open(clean, "w") as f:
        f.write("Cancelled,ArrDelay\n0,5\n")
    assert scan_rejects(spark, clean).count() == 0
    both = {(r.column_name, r.reject): r.lines for r in scan_rejects(spark, [path, path]).collect()}
    assert both == {k: 2 * n for k, n in got.items()}
