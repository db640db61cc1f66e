import unicodedata

from pyspark.sql import functions as F

from clauselens.functions import text as T
from clauselens.functions.parse import currency_code, law_category, parse_date, parse_number, round_exact
from clauselens.operators import prepare as P


def column(spark, fn, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in frame.orderBy("i").select(fn(F.col("x"))).collect()]


def test_dates(spark):
    raw = ["31/12/2025", "12/31/2025", "05/06/2025", "05/05/2025", "15 août 2025", "March 3, 2024", "30 February 2025",
           "2025-1-5", "(1st  March 2020).", "0000-01-01", "13/13/2020", "mars 2020", "", None]
    assert column(spark, parse_date, raw) == [
        "2025-12-31", "2025-12-31", None, None, "2025-08-15", "2024-03-03", None, "2025-01-05", "2020-03-01", None,
        None, None, None, None]


def test_numbers(spark):
    raw = ["1.234,56", "1,234.56", "1,234", "12,5", "1.500", "1 200 000", "1,234,567", "", "EUR 5", ".", "1.234.5", "7."]
    assert column(spark, parse_number, raw) == [
        1234.56, 1234.56, 1234.0, 12.5, 1500.0, 1200000.0, 1234567.0, None, 5.0, None, 12345.0, 7.0]


def test_currency_and_law(spark):
    assert column(spark, currency_code, ["eur", "US$", "c$", "€", "$", "XYZ", None]) == [
        "EUR", "USD", "CAD", "EUR", None, None, None]
    assert column(spark, law_category, [
        "Laws of the State of Delaware", "New England", "Droit français", "Swiss law", "", None, "Deutsches Recht"]) == [
        "us_ny", "english", "french", "other", None, None, "german"]


def test_fold_agrees_with_unicode(spark):
    words = ["Résiliation", "ÉCHÉANCE", "plain", "oﬃce ½ …", "Œuvre", "ﬁn", "Ｆｅｅ", "éte", "Straße", "№ 5"]
    fold = lambda w: "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c)).lower()
    assert column(spark, T.fold, words) == [fold(w) for w in words]


def test_whitespace_and_quotes(spark):
    assert column(spark, T.squeeze, ["  a \t b\n\nc ", "a  b", "x\x1cy", "plain text", "é  è"]) == [
        "a b c", "a b", "x y", "plain text", "é è"]
    assert column(spark, T.strip, ["  a \x1f", "", "\n"]) == ["a", "", ""]
    long = "word " * 100
    assert column(spark, T.quote, [long, "short"]) == [long.strip(), "short"]
    assert column(spark, lambda c: T.quote(c, 240), [long, "short"]) == [(long.strip()[:237]).rstrip() + "...", "short"]


def test_lines(spark):
    raw = ["a\r\nb\rc\x0bd e", "", "x\n", "x\n\n", "\n", "é\u0085f"]
    assert column(spark, T.split_lines, raw) == [v.splitlines() for v in raw]


def test_clauses(spark):
    raw = ["One. Two; three\n\n  \nFour.Five", "A.\nB", "é. è; à"]
    assert column(spark, T.split_clauses, raw) == [["One.", "Two;", "three", "Four.Five"], ["A.", "B"], ["é.", "è;", "à"]]
    assert column(spark, T.split_clauses, ["x" * 500])[0] == ["x" * 500]
    cut = column(spark, lambda c: T.split_clauses(c, 400), ["x" * 500])[0][0]
    assert len(cut) == 400 and cut.endswith("x...")


def test_markdown(spark):
    raw = ["# Title\n\n\n\n**bold** and *it* __b__ snake_case_words\n---\nend  "]
    assert column(spark, T.clean_markdown, raw) == ["Title\n\nbold and it b snakecasewords\n\nend"]


def test_long_tables_keep_order(spark):
    rows = spark.createDataFrame([(1, "a. b. c."), (2, "")], "contract_id long, text string")
    assert [(r.clause_idx, r.clause) for r in P.to_clauses(rows).orderBy("clause_idx").collect()] == [
        (0, "a."), (1, "b."), (2, "c.")]
    assert P.to_lines(rows).filter("contract_id = 2").count() == 0


def test_dedupe_warnings(spark):
    row = spark.range(1).select(T.dedupe_warnings(F.array(*[F.lit(w) for w in (" b ", "a", "b", "", "  ")]))).first()
    assert row[0] == ["b", "a"]


def test_exact_rounding(spark):
    values = [k / 100000 for k in range(5, 100000, 10)] + [0.0, 1.0, 0.125, 0.31234567, 0.03125, 2.675]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in frame.select(round_exact(F.col("x"), 4)).collect()] == [round(v, 4) for v in values]
    assert [r[0] for r in frame.select(round_exact(F.col("x") / 64, 6)).collect()] == [round(v / 64, 6) for v in values]


def test_fold_of_every_code_point(spark):
    hangul = range(0xAC00, 0xD7A4)
    points = [cp for cp in range(0x110000) if not 0xD800 <= cp < 0xE000 and cp not in hangul and cp not in (0x130, 0x3A3)]
    chunks = [points[i:i + 2_000] for i in range(0, len(points), 2_000)]
    frame = spark.createDataFrame([(i, [chr(cp) for cp in c]) for i, c in enumerate(chunks)], "i int, x array<string>")
    got = frame.repartition(8).select("i", F.transform("x", T.fold_ref).alias("y")).collect()
    for r in got:
        for cp, folded in zip(chunks[r.i], r.y):
            plain = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c))
            # lower case is a matter of the Unicode version of the JVM; the decomposition is what is compared
            assert folded in (plain.lower(), plain) or folded.casefold() == plain.casefold(), hex(cp)


def test_fold_costs_no_more_with_long_forms(spark):
    """One character with a longer form in a long text is replaced where it stands, the rest is not looked up."""
    import time

    plain = "Les prix hors taxes sont dûs à l'échéance. " * 10_000
    frame = spark.createDataFrame([(0, plain), (1, plain + "…"), (2, plain + "ﬁn ½ … ﬁn")], "i int, t string").coalesce(1).cache()
    ends = [r[0] for r in frame.orderBy("i").select(F.substring(T.fold(F.col("t")), -12, 12)).collect()]
    assert ends[1].endswith("eance. ...") and ends[2].endswith("fin 1\u20442 ... fin"[-12:])

    def seconds(i):
        best = 1e9
        for _ in range(5):
            began = time.time()
            frame.where(f"i = {i}").select(T.fold(F.col("t"))).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - began)
        return best

    assert seconds(1) < 1.5 * seconds(0) + 0.1
