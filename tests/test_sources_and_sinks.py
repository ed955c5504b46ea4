"""Readers and writers, by writing files and reading them back."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.plans.indicator import Indicator
from maillage.sinks.writers import write_csv, write_layouts, write_parquet
from maillage.sources import links, paged_json, preamble, readers, schemas, snapshots


def put(path, content, encoding="utf-8"):
    path.write_bytes(content.encode(encoding))
    return str(path)


def test_codes_keep_their_zeros(spark, tmp_path, rows):
    path = put(tmp_path / "a.csv", "code,n\n01001,1\n02A04,\n")
    df = readers.read_delimited(spark, path, "code string, n int")
    assert rows(df) == [("01001", 1), ("02A04", None)]


def test_tabs_and_semicolons(spark, tmp_path, rows):
    tab = put(tmp_path / "a.tsv", "Nom\tId\nLe Mag, SA\t1\n")
    assert rows(readers.read_delimited(spark, tab, "Nom string, Id int", sep="\t")) == [("Le Mag, SA", 1)]


def test_headers_are_checked(spark, tmp_path):
    path = put(tmp_path / "a.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        readers.read_delimited(spark, path, "a string, b string").collect()


def test_latin1(spark, tmp_path, rows):
    path = put(tmp_path / "epci.csv", "siren;raison_sociale\n200;Communauté d'Évry\n", "latin-1")
    schema = readers.text_schema("siren", "raison_sociale")
    assert rows(readers.read_latin1(spark, path, schema)) == [("200", "Communauté d'Évry")]


def test_positional(spark, tmp_path, rows):
    path = put(tmp_path / "p.csv", "meta;etalab;v1\n1;x;75012 PARIS;Phar\n2;y;01000 BOURG;Labo\n")
    got = readers.read_positional(spark, path, {2: "adresse", 3: "type"})
    assert rows(got) == [("01000 BOURG", "Labo"), ("75012 PARIS", "Phar")]


def test_tolerant_and_quarantined(spark, tmp_path, rows):
    path = put(tmp_path / "t.csv", "a,n\nx,1\ny,bad\nz,3\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])
    good = readers.read_tolerant(spark, path, schema)
    assert rows(good) == [("x", 1), ("z", 3)]
    assert rows(good.select("a")) == [("x",), ("z",)] and good.count() == 2
    kept = readers.read_quarantined(spark, path, schema)
    assert rows(kept.where(F.col(readers.CORRUPT).isNull()).select("a")) == [("x",), ("z",)]
    assert rows(kept.where(F.col(readers.CORRUPT).isNotNull()).select(readers.CORRUPT)) == [("y,bad",)]


def test_active_rows_of_like_named_files(spark, tmp_path, rows):
    head = "id;position;adrs_codeinsee;adrs_codepostal\n"
    put(tmp_path / "rna_waldec_01.csv", head + "1;A;01001;01000\n2;D;01002;01000\n")
    put(tmp_path / "rna_waldec_02.csv", head + "3;A;;02000\n")
    put(tmp_path / "other.csv", "a;b\n1;2\n")
    got = readers.read_active(spark, str(tmp_path), schemas.ASSOCIATIONS)
    assert rows(got) == [(None, "02000"), ("01001", "01000")]


def test_regional_files_in_one_scan(spark, tmp_path, rows):
    head = "NUMERO_AMALIA;COMMUNE;CODE_POSTAL;ETAT_ASSOCIATION\n"
    paths = [
        put(tmp_path / f"asso_{d}.csv", f"{head}{d};METZ;{d}000;INSCRITE\n") for d in (57, 67, 68)
    ]
    df = readers.read_delimited(spark, paths, schemas.REGIONAL_ASSOCIATIONS, sep=";")
    assert rows(df.select("NUMERO_AMALIA")) == [("57",), ("67",), ("68",)]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_pages(spark, tmp_path, rows):
    for i in range(3):
        page = {"total_count": 5, "results": [{"numepci": f"20{i}", "txcouv_epci": i + 0.5, "x": 1},
                                              {"numepci": f"21{i}", "txcouv_epci": None}]}
        put(tmp_path / f"page{i}.json", json.dumps(page, indent=1))
    df = paged_json.read_pages(spark, str(tmp_path), schemas.CHILDCARE_RECORD)
    want = [("200", 0.5), ("201", 1.5), ("202", 2.5), ("210", None), ("211", None), ("212", None)]
    assert rows(df) == want


def test_directory_file(spark, tmp_path, rows):
    path = put(tmp_path / "m.txt", '<ul>\n<a href="#">Le Mag (Paris)</a>\r\n<a href="#">Tamtam</a>\n')
    assert rows(links.read_directory(spark, path)) == [("Le Mag", "Paris"), ("Tamtam", "Inconnue")]


APL = T.StructType([T.StructField("code", T.StringType()), T.StructField("apl", T.DoubleType())])


def test_header_anywhere(spark, tmp_path, rows):
    put(tmp_path / "a.csv", "Titre\n\nnote;x\nCode commune INSEE;APL\n01001;2.5\n01002;\n")
    put(tmp_path / "b.csv", "Commune;APL\n02001;1.5\nCommune fictive;9\n")
    late = "".join(f"ligne {i};0\n" for i in range(20))
    put(tmp_path / "c.csv", f"{late}Commune;1\n03001;7\n")
    df = preamble.read_after_header(spark, f"{tmp_path}/*.csv", APL)
    got = df.select(F.regexp_extract("file", r"(\w)\.csv", 1), "code", "apl")
    assert [r for r in rows(got) if r[0] != "c"] == [
        ("a", "01001", 2.5),
        ("a", "01002", None),
        ("b", "02001", 1.5),
        ("b", "Commune fictive", 9.0),
    ]
    assert [r for r in rows(got) if r[0] == "c"] == [("c", "03001", 7.0)]
    # only where a window is asked for, line 0 stands in for a header beyond it
    short = preamble.read_after_header(spark, f"{tmp_path}/c.csv", APL, window=15)
    assert short.count() == 21
    put(tmp_path / "d.csv", "no;header\n1;2\n")
    with pytest.raises(Exception, match="no header in the first split"):
        preamble.read_after_header(spark, f"{tmp_path}/d.csv", APL).collect()


def test_preambles_are_decoded(spark, tmp_path, rows):
    text = "Titre é\nCommune;APL\nSaint-Étienne;1.5\nBègles;2\n"
    path = put(tmp_path / "l.csv", text, "latin-1")
    want = [("Bègles", 2.0), ("Saint-Étienne", 1.5)]
    assert rows(preamble.read_after_header(spark, path, APL, encoding="ISO-8859-1").drop("file")) == want
    assert rows(preamble.read_skipping(spark, path, APL, skip=1, encoding="ISO-8859-1").drop("file")) == want


def test_quoted_line_breaks(spark, tmp_path, rows):
    path = put(tmp_path / "q.csv", 'n;a\n1;"a\nb"\n2;c\n')
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("a", T.StringType())])
    assert rows(readers.read_delimited(spark, path, schema, sep=";", multi_line=True)) == [(1, "a\nb"), (2, "c")]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_delimited(spark, path, schema, sep=";").collect()
    assert rows(readers.read_tolerant(spark, path, schema, sep=";")) == [(2, "c")]
    bad = readers.read_quarantined(spark, path, schema, sep=";").where(F.col(readers.CORRUPT).isNotNull())
    assert rows(bad.select(readers.CORRUPT)) == [('1;"a',), ('b"',)]


def test_header_detection_in_a_file_of_many_splits(spark, tmp_path, rows):
    body = "".join(f"{i:05d};{i}.0\n" for i in range(20_000))
    path = put(tmp_path / "big.csv", f"Titre\nCommune;APL\n{body}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    try:
        df = preamble.read_after_header(spark, path, APL)
        assert df.rdd.getNumPartitions() > 1
        got = df.agg(F.count("*"), F.sum("apl"), F.min("code"), F.countDistinct("code")).first()
        assert tuple(got) == (20_000, sum(range(20_000)), "00000", 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_fixed_preamble(spark, tmp_path, rows):
    path = put(tmp_path / "d.csv", "Source\n2024\nCode;Libellé;distance\n01001;A;3.5\n01002;B;N/A\n")
    df = preamble.read_skipping(spark, path, schemas.DISTANCES, skip=2)
    assert rows(df.drop("file")) == [("01001", "A", "3.5"), ("01002", "B", "N/A")]


def test_header_rows_of_numbered_lines(frame, rows):
    lines = frame(
        "file string, line_no int, value string",
        ("a", 0, "x"), ("a", 1, "Commune"), ("a", 2, "Commune"), ("b", 0, "x"), ("b", 15, "Commune"),
    )
    assert rows(preamble.header_rows(lines)) == [("a", 1), ("b", 15)]
    headers = preamble.header_rows(lines, window=15)
    assert rows(headers) == [("a", 1), ("b", 0)]
    assert rows(preamble.data_lines(lines, headers).select("file", "line_no")) == [("a", 2), ("b", 15)]


def test_latest_snapshot(frame, rows):
    df = frame(
        "d string, sheet string, v int",
        ("a", "APL 2021", 1), ("a", "APL 2023", 2), ("a", "notes", 3), ("a", "APL 2023", 4),
        ("b", "z", 5), ("b", "m", 6),
    )
    got = snapshots.latest_snapshot(df, dataset="d", label="sheet")
    assert rows(got) == [("a", "APL 2023", 2), ("a", "APL 2023", 4), ("b", "m", 6)]


def test_csv_and_parquet_sinks(spark, tmp_path, frame, rows):
    df = frame("epci_code string, apl double", ("200", 1.5), (None, None))
    write_csv(df, f"{tmp_path}/out", sep=";")
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*.csv")))
    assert "epci_code;apl\n" in text and "200;1.5\n" in text
    assert rows(readers.read_delimited(spark, f"{tmp_path}/out", df.schema, sep=";")) == rows(df)
    write_parquet(df, f"{tmp_path}/pq")
    assert rows(spark.read.parquet(f"{tmp_path}/pq")) == rows(df)


def test_registered_table(spark, frame, rows):
    readers.register(frame("a int", (1,), (2,)), "registered_for_test")
    assert rows(spark.sql("SELECT SUM(a) FROM registered_for_test")) == [(3,)]


def test_layout_files(spark, tmp_path, frame):
    values = frame("id_epci string, valeur_brute double", ("200", 1.25), ("201", None))
    named = frame("id_epci string, nom_epci string, dept string", ("201", "B", "01"), ("200", "A", "01"),
                  ("202", "C", None))
    write_layouts(Indicator("i000", "2025", values, named), str(tmp_path))

    def lines(name):
        parts = sorted((tmp_path / name).glob("part-*.csv"))
        texts = [p.read_text().splitlines() for p in parts]
        return [texts[0][0], *[line for t in texts for line in t[1:]]]

    assert lines("i000_complete") == [
        "dept,id_epci,nom_epci,id_indicator,valeur_brute",
        "01,200,A,i000,1.25",
        "01,201,B,i000,",
        ",202,C,i000,",
    ]
    short = lines("i000_short")
    assert short[0] == "id_epci,id_indicator,valeur_brute,annee"
    assert sorted(short[1:]) == ["200,i000,1.25,2025", "201,i000,,2025"]
