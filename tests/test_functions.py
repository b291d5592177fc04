"""Published vectors: pseudonyms, histograms; dates and the key service."""

import pytest
from pyspark.sql import functions as F

from mosaique.functions import crypto, dates, histogram

VECTORS = [
    ("608b23b723630c304385b4ebd0053701", "13bffe75261b0fa784423094936ba6d7", "95e5124fa2530b6bec01ff60"),
    ("f802f981654d24bba81497a62e8ba0bc", "ae24facc6406bf8f98d2cc451f3ba73c", "af5570f5a1810b7af78caf4b"),
]


@pytest.mark.parametrize(("key", "pseudonym", "own"), VECTORS)
def test_pseudonyms(spark, key, pseudonym, own):
    key = bytes.fromhex(key)
    row = spark.createDataFrame([(bytes.fromhex(pseudonym), bytes.fromhex(own))], "p binary, o binary")
    got = row.select(crypto.depseudonymise(F.col("p"), key), crypto.pseudonymise(F.col("o"), key), crypto.hmac_tag(F.col("o"), key)).first()
    assert bytes(got[0]).hex() == own and bytes(got[1]).hex() == pseudonym
    assert bytes(got[2]) == crypto.tag_of(bytes.fromhex(own), key)


def test_a_changed_pseudonym_fails_the_job(spark):
    row = spark.createDataFrame([(bytes(16),)], "p binary")
    with pytest.raises(Exception, match="does not verify"):
        row.select(crypto.depseudonymise(F.col("p"), bytes(16)).alias("x")).collect()


def test_service(spark):
    keys = crypto.KeyTable()
    keys.generate(18628)
    with pytest.raises(ValueError, match="already"):
        keys.generate(18628)
    with pytest.raises(ValueError, match="range"):
        keys.generate(2**32)
    with pytest.raises(ValueError, match="one"):
        keys.generate(1, 2)
    service = crypto.PseudonymService(spark, keys)
    ids = ["310170845466094", "502130123456789", "1", "2"]
    a, b = service.pseudonymise(18628, ids), service.pseudonymise(18628, ids)
    assert a == b and len(set(a)) == 4
    with pytest.raises(ValueError, match="list"):
        service.pseudonymise(18628, "1")
    keys.delete(18628)
    with pytest.raises(KeyError):
        service.pseudonymise(18628, ids)
    with pytest.raises(KeyError):
        crypto.lookup_key(spark.createDataFrame([], "period int, key binary"), 1)


def _quarters():
    return [0.0, 0.001] + [x for i in range(1, 96) for v in [0.0625 * i] for x in (v - 0.01, v, v + 0.01)]


def _halves():
    return [0.0, 0.001] + [x for i in range(2, 66) for v in [0.5 * i] for x in (v - 0.01, v, v + 0.01)]


#: Published lines of five bins, empty and filled, at k = 1.
CASES = [
    (1, [float(i) for i in range(35)], ["\t\t < 1: 1 (2.9 %)", "\t\t < 2: 1 (5.7 %)", "\t\t < 4: 2 (11.4 %)", "\t\t < 8: 4 (22.9 %)", "\t\t>= 8: 27 (100.0 %)"]),
    (0.25, _quarters(), ["\t\t < 1/4: 12 (4.2 %)", "\t\t < 1/2: 12 (8.4 %)", "\t\t < 1: 24 (16.7 %)", "\t\t < 2: 48 (33.4 %)", "\t\t>= 2: 191 (100.0 %)"]),
    (8, _halves(), ["\t\t < 8: 45 (23.2 %)", "\t\t < 16: 48 (47.9 %)", "\t\t < 32: 96 (97.4 %)", "\t\t < 64: 5 (100.0 %)", "\t\t>= 64: NA (NA %)"]),
]
EMPTY = {
    1: ["\t\t < 1: NA (NA %)", "\t\t < 2: NA (NA %)", "\t\t < 4: NA (NA %)", "\t\t < 8: NA (NA %)", "\t\t>= 8: NA (NA %)"],
    0.25: ["\t\t < 1/4: NA (NA %)", "\t\t < 1/2: NA (NA %)", "\t\t < 1: NA (NA %)", "\t\t < 2: NA (NA %)", "\t\t>= 2: NA (NA %)"],
    8: ["\t\t < 8: NA (NA %)", "\t\t < 16: NA (NA %)", "\t\t < 32: NA (NA %)", "\t\t < 64: NA (NA %)", "\t\t>= 64: NA (NA %)"],
}


@pytest.mark.parametrize(("lowest", "data", "lines"), CASES)
def test_histograms(spark, lowest, data, lines):
    df = spark.createDataFrame([(x,) for x in data], "x double")
    text = lambda rows: [r["line"] for r in histogram.format_lines(histogram.iterate(histogram.log2_histogram(rows, "x", 5, lowest), None, 5), 5, lowest, 1, "\t\t").orderBy("bin").collect()]
    assert text(df) == lines and text(df.limit(0)) == EMPTY[lowest]


def test_histogram_edges(spark):
    values = [0.0, 0.999, 1.0, 1.999, 2.0, 4.0, 8.0, 1e300]
    df = spark.createDataFrame([(x,) for x in values], "x double").select(histogram.log2_bin(F.col("x"), 5, 1).alias("b"))
    assert [r["b"] for r in df.collect()] == [0, 0, 1, 1, 2, 3, 4, 4]
    with pytest.raises(Exception, match="not finite"):
        spark.createDataFrame([(float("nan"),)], "x double").select(histogram.log2_bin(F.col("x"), 5, 1).alias("b")).collect()


def test_k_anonymous(spark):
    df = spark.createDataFrame([(19, 1.0), (20, 99.95)], "c int, p double")
    got = df.select(histogram.k_anonymous(F.col("c"), 20), histogram.k_anonymous_pct(F.col("c"), F.col("p"), 20)).collect()
    assert tuple(got[0]) == ("NA", "NA %") and got[1][0] == "20" and got[1][1].endswith(" %")


def test_dates():
    assert dates.period_of("2021-01-01") == 18628 and dates.date_of(18628) == "2021-01-01"
    for bad in ("2021-1-1", "1969-12-31", "2021-02-30", "x"):
        with pytest.raises(ValueError):
            dates.period_of(bad)
