"""Tables of pages as grids, raw records to typed columns, and the composition of a company's entry."""

import json

import pytest
from pyspark.sql import functions as F

from siftwell.functions import shredding, structure
from siftwell.functions.dom import parsed
from siftwell.operators import registry
from siftwell.plans import catalog, sites


@pytest.mark.parametrize("html,want", [
    ("<table><tr><td>a<td>b<tr><td>c</table>", [["a", "b"], ["c"]]),
    ("<table><tr><th colspan=2>ab<th>c</tr><tr><td rowspan=2>d<td>e<td>f</tr><tr><td colspan=2>gh</tr></table>", [["ab", "ab", "c"], ["d", "e", "f"], ["d", "gh", "gh"]]),
    ("<table><tr><td rowspan=0>x<td>1<tr><td>2<tr><td>3</table>", [["x", "1"], ["x", "2"], ["x", "3"]]),
    ("<table><tr><td>1<td rowspan=2 colspan=2>w</tr><tr><td>2<td>end</tr></table>", [["1", "w", "w"], ["2", "w", "w", "end"]]),
    ("<table><tr><td>out<table><tr><td>in</table><td>more</table>", [["out", "more"]]),
    ("<table><thead><tr><th> a <b> b</b></thead><tbody><tr><td colspan=0>c<td colspan=x>d<tr><td> </tbody></table>", [["ab"], ["c", "d"]]),
    ("<table></table>", []),
])
def test_grids(html, want):
    assert structure.grid(next(parsed(html).all(lambda e: e.tag == "table"))) == want


def test_cells_that_nothing_closes():
    assert structure.grid(next(parsed("<table><tr><td>a</td></tr><tr><td rowspan='2'>b</td><td>c</td></tr><tr><td>d</td></tr></table>").all(lambda e: e.tag == "table"))) == [["a"], ["b", "c"], ["b", "d"]]


PAGE = """<h1>Maison <b>Bleue</b></h1><script>var x = "SIREN 999999999"</script><div class="table-container big"><p>Raison sociale:</p><p>MB</p><p>Adresse:</p><p>1 rue X 75001 Paris</p></div>
<p>Siret : 123 456 789 00012</p><p>Effectif 2021</p><p>50 à 99 salariés</p><div class="Finances-Bloc"><p>CA 2020</p><p>10</p></div><div id="les-chiffres"><p>Total du bilan</p><p>5 M€</p></div>
<div class="dirigeant"><span>Ann Doe</span><span>Gérante, ancienne</span></div><table><tr><td>1</td></tr></table><table></table>"""


def test_structure_of_pages(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "i int, html string")
    read = pages.withColumn("s", structure.structure("html")).select("i", "s.*", structure.identifiers(F.col("s.text")).alias("ids"), structure.lines_about(F.col("s.text")).alias("lines"), structure.years_with_context(F.col("s.text")).alias("years"))
    a, b, c = read.orderBy("i").collect()
    assert a.title == "MaisonBleue" and a.pairs == {"Raison sociale": "MB", "Adresse": "1 rue X 75001 Paris"} and a.people == [["Ann Doe", "Gérante, ancienne"]] and a.tables == [[["1"]]]
    assert a.sections == {"finances_bloc": ["CA 2020\n10"], "id_chiffres": "Total du bilan\n5 M€".split("\x00")}
    assert (a.ids.siret, a.ids.siren, a.ids.headcount, a.ids.address) == ("123 456 789 00012", None, "50 à 99 salariés", "1 rue X 75001 Paris")
    assert a.lines["ca_lines"] == ["CA 2020\n10"] and a.lines["bilan_lines"] == ["Total du bilan\n5 M€"] and a.lines["effectif_hist"] == ["2021"] and "dettes_lines" not in a.lines
    assert [tuple(y) for y in a.years] == [("2021", "50 à 99 salariés"), ("2020", "10")]
    for r in (b, c):
        assert (r.title, r.text, r.pairs, r.people, r.tables, r.sections, r.lines, r.years) == (None, "", {}, [], [], {}, {}, [])


def test_shredding(spark):
    fields = {"n": ("$.n", "int"), "t": ("$.a.t", "string"), "xs": ("$.xs", "array<int>")}
    cases = [
        ('{"n": 1, "a": {"t": "x"}, "xs": [1, 2]}', (1, "x", [1, 2], [])), ('{"n": "5", "a": {"t": 7}, "xs": []}', (5, "7", [], [])),
        ('{"n": "many", "a": {"t": {"deep": 1}}, "xs": {"k": 1}}', (None, None, None, ["$.n", "$.a.t", "$.xs"])), ('{"n": null, "other": 1}', (None, None, None, [])),
        ("{", (None, None, None, ["$"])), ("", (None, None, None, ["$"])), (None, (None, None, None, [])), ("[1]", (None, None, None, [])),
    ]
    rows = spark.createDataFrame([(k, j) for k, (j, _) in enumerate(cases)], "k int, j string").select("k", shredding.shred(F.col("j"), fields).alias("r")).orderBy("k").collect()
    assert [tuple(r.r) for r in rows] == [want for _, want in cases]


def test_composition(spark):
    raw = {
        "_meta": {"url": "u", "match_score": 60}, "identite": {"company_name_raw": " ", "siren_raw": "123 456 789", "vat_raw": "FR 12 123456789", "naf_raw": "code 6201z", "legal_form_raw": "SAS au Capital de 5", "effectif_raw": "50 à 99 salariés", "adresse_raw": "1 rue X 69001 Lyon", "main_bloc_pairs": {"Raison sociale": "Acme", "Création": "en 1999", "Activité": "Conseil"}},
        "dirigeants": [{"parts_raw": ["Ann Doe", "Gérante"]}, {"parts_raw": ["Bob Roe", "Président", "née 1970"]}], "html_tables": [{"rows": [["", "2022", "2023"], ["CA", "100 k€", "150 k€"], ["Résultat net", "1", "15 000 €"]]}], "finances_raw": {"year_contexts_raw": [{"year": "2021", "context": "9 000 €"}]}, "xhr_finances": {},
    }
    landed = spark.createDataFrame([(1, json.dumps(raw)), (1, json.dumps(raw)), (2, "no"), (3, None)], "company_id long, json string")
    got = {r.company_id: r for r in registry.composed(registry.raw_of_records(landed), 2026).collect()}
    r = got[1]
    assert (r.name, r.siren, r.vat, r.naf, r.legal_form, r.postcode, r.city, r.sector, r.founded, r.age, r.headcount.label) == ("Acme", "123456789", "FR12123456789", "6201Z", "SAS au", "69001", "Lyon", "Conseil", 1999, 27, "ME")
    assert [p.name for p in r.leaders] == ["Bob Roe"] or [p.name for p in r.leaders] == ["Ann Doe", "Bob Roe"]
    assert (r.year, r.ca, r.resultat_net, r.growth_pct, r.margin_pct, r.rejected) == (2023, 150000.0, 15000.0, 50.0, 10.0, [])
    assert r.sales.label == "A" and r.sales.priority == "haute"
    assert got[2].rejected == ["$"] and got[2].sales.score == 0 and got[2].leaders == [] and got[3].rejected == [] and len(got) == 3
    assert registry.composed(registry.raw_of_records(landed.limit(0)), 2026).count() == 0


def test_rows_of_one_file_are_dealt_and_pages_parsed_once(spark, tmp_path):
    """All rows of a table of one row group would be one task's; what is read from a page is written once."""
    spark.range(1, 41).selectExpr("id AS c_custkey", "concat('Customer', id) AS c_name", "CAST(id AS DOUBLE) AS c_acctbal").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    assert catalog._t(spark, str(tmp_path), "customer").rdd.getNumPartitions() == 1 and sites.registry_pages(spark, str(tmp_path)).rdd.getNumPartitions() >= 8
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(html):
        calls.add(1)
        return html

    pages = sites.registry_pages(spark, str(tmp_path)).withColumn("html", counted.asNondeterministic()("html"))
    assert registry.composed(registry.raw_of_pages(pages), 2026).count() == 40
    assert calls.value == 40
