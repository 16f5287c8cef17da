import unicodedata

import pytest

from tessera.functions import text as N

NAMES = {
    "Orelee's  Barbershop": "orelee s barbershop",
    "Thermal & Fils SASU": "thermal and fils sasu",
    "Café München": "cafe munchen",
    "STRAßE ① ½": "strasse 1 1 2",
    "a b‍c　d\U0001f600e": "a b‍c d e",
    "B+ Retail 24x7": "b plus retail 24x7",
    "×÷": "×÷",
    None: "",
    " \t": "",
    "राम मार्केटिंग।": unicodedata.normalize("NFKD", "राम मार्केटिंग"),
}
SUFFIX = {"Golden Power Private Limited": "golden power", "B+ Retail Inc": "b plus retail", "Private Limited": "", "Group Acme And Sons Co": "acme and sons", None: ""}
ADDRESSES = {"16449 Evans Rd Unit 4": "16449 evans road unit 4", "16449 Evans Rd Apt 4": "16449 evans road unit 4", "1795 Westchester Dr, Suite 200": "1795 westchester drive unit 200"}


@pytest.fixture
def one(spark):
    def run(name=None, address=None):
        df = spark.createDataFrame([(1, name, address, "z")], "entity_id long, name string, address string, keep string")
        return N.normalize(df).first()

    return run


def test_names_and_addresses(spark):
    rows = [(k, n, None) for k, n in enumerate(NAMES)] + [(100 + k, n, None) for k, n in enumerate(SUFFIX)] + [(200 + k, None, a) for k, a in enumerate(ADDRESSES)]
    got = {r.entity_id: r for r in N.normalize(spark.createDataFrame(rows, "entity_id long, name string, address string")).collect()}
    assert [got[k].name_norm for k in range(len(NAMES))] == list(NAMES.values())
    assert [got[100 + k].name_ss for k in range(len(SUFFIX))] == list(SUFFIX.values())
    assert [got[200 + k].addr_norm for k in range(len(ADDRESSES))] == list(ADDRESSES.values())


def test_columns(one):
    row = one("Acme Pvt Ltd 007 7 24x7 99999999999999999999 २४", "00309 Elm St Apt 12, Bldg B2, 560001")
    assert tuple(row.asDict())[:4] == ("entity_id", "name", "address", "keep") and tuple(row.asDict())[4:] == N.NORMALIZED
    assert row.name_tok.startswith("acme private limited 007") and row.name_num == "7,24,99999999999999999999"
    assert (row.street_num, row.unit_num, row.bldg_num, row.postal, row.has_addr) == ("309", "12", "b2", "00309", True)
    row = one("x", "Near SBI ATM, building 5")
    assert (row.street_num, row.unit_num, row.bldg_num, row.postal) == ("", "5", "5", "")
    row = one(None, None)
    assert (row.name_norm, row.addr_norm, row.name_num, row.has_addr) == ("", "", "", False)
