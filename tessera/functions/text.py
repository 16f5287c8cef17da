"""Unicode-safe normalisation of names and addresses.

Only compatibility folding (NFKD and case folding) leaves the JVM, and only for
texts that are not plain ASCII; everything after it is Catalyst expressions.
Missing values are empty strings.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal words that end (or begin) a business name.
LEGAL = (
    "pvt private ltd limited llc llp inc incorporated corp corporation co company sarl sas sasu eurl sa sci srl gmbh bv nv plc pty "
    "traders trading enterprises enterprise group services service solutions and associates partners holdings industries "
    "consultants consulting agency stores store shop centre center"
).split()
# Abbreviations in names.
NAME_WORDS = {"pvt": "private", "ltd": "limited", "inc": "incorporated", "corp": "corporation", "co": "company"}
# Abbreviations in addresses.
ADDRESS_WORDS = {
    "rd": "road", "st": "street", "ave": "avenue", "av": "avenue", "apartment": "unit", "apt": "unit", "ste": "unit", "suite": "unit",
    "flat": "unit", "number": "unit", "no": "unit", "blvd": "boulevard", "dr": "drive", "ln": "lane", "ct": "court", "hwy": "highway",
    "pkwy": "parkway", "sq": "square", "fl": "floor", "bldg": "building", "n": "north", "s": "south", "e": "east", "w": "west",
}
# Words that a unit or a building number follows.
UNIT_WORDS = "unit suite ste apt flat no number floor bldg building".split()
BUILDING_WORDS = "bldg building tower block".split()
# Fixed values, in hex: blocks of combining marks that folding removes; marks of other scripts carry meaning and stay.
MARK_BLOCKS = "0300-036F 1AB0-1AFF 1DC0-1DFF 20D0-20F0 FE20-FE2F"
# Fixed values, in hex: white space, and the punctuation and symbols that separate words.
SEPARATOR_BLOCKS = (
    "0000-0020 007F 0085 00A0 1680 2000-200A 2028-2029 202F 205F 3000 "
    "0021-002F 003A-0040 005B-0060 007B-007E 00A1-00BF 037E 0387 055A-055F 0589-058A 0609-060D 061B 061E 061F 066A-066D 06D4 "
    "0964 0965 2010-2027 2030-205E 20A0-20BF 2100-214F 2190-24FF 2500-27BF 2983-2998 2E00-2E7F 3000-303F FE10-FE6B FF01-FF65 1F300-1FAFF"
)
_MARKS = {c: None for block in MARK_BLOCKS.split() for c in range(int(block[:4], 16), int(block[-4:], 16) + 1)}
_RANGES = [(int(block.split("-")[0], 16), int(block.split("-")[-1], 16)) for block in SEPARATOR_BLOCKS.split()]
SEPARATORS = "[" + "".join(f"\\x{{{a:04X}}}-\\x{{{b:04X}}}" for a, b in _RANGES) + "]+"
# those of ASCII alone, as a long class costs much for each character
_ASCII_SEPARATORS = "[" + "".join(f"\\x{a:02X}-\\x{b:02X}" for a, b in _RANGES if b < 128) + "]+"
_SEPARATE = re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _RANGES) + "]+")
DIGITS = "".join(chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Nd")
ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in DIGITS)
NUMBER = r"^\p{Nd}+$"


def _folded(text: str) -> str:
    return unicodedata.normalize("NFKD", text).translate(_MARKS).casefold()


@F.pandas_udf(T.StringType())
def _fold_unicode(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else _folded(t))


@F.pandas_udf(T.StringType())
def _normalize_unicode(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else _SEPARATE.sub(" ", _folded(t).replace("&", " and ").replace("+", " plus ")).strip(" "))


def fold(text: Column) -> Column:
    plain = text.rlike(r"^[\x00-\x7F]*$")
    return F.coalesce(F.when(plain, F.lower(text)), _fold_unicode(F.when(~plain, text)))


def normalize_text(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    plain = text.rlike(r"^[\x00-\x7F]*$")
    spelled = F.replace(F.replace(F.lower(text), F.lit("&"), F.lit(" and ")), F.lit("+"), F.lit(" plus "))
    return F.coalesce(F.when(plain, F.trim(F.regexp_replace(spelled, _ASCII_SEPARATORS, " "))), _normalize_unicode(F.when(~plain, text)))


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, " "), "")


def expand(words: Column, table: dict[str, str]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    # a map is searched key by key, a set by hash
    return F.transform(words, lambda x: F.when(x.isin(list(table)), F.try_element_at(known, x)).otherwise(x))


def strip_legal(words: Column) -> Column:
    """Words without the legal ones at the end and then at the beginning."""
    legal = F.array(*map(F.lit, LEGAL))
    own = F.filter(F.transform(words, lambda x, i: F.when(~F.array_contains(legal, x), i)), lambda i: i.isNotNull())
    return F.when(F.size(own) == 0, F.array().cast("array<string>")).otherwise(F.slice(words, F.array_min(own) + 1, F.array_max(own) - F.array_min(own) + 1))


def whole_number(digits: Column) -> Column:
    """Digits of any script as an ASCII number without leading zeros, whatever its length."""
    return F.regexp_replace(F.translate(digits, DIGITS, ASCII_DIGITS), "^0+(?=.)", "")


def number_set(text: Column) -> Column:
    """The distinct whole numbers in a text, ascending, joined by commas."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"\p{Nd}+"), F.lit(0)), whole_number))
    return F.array_join(F.transform(F.array_sort(F.transform(found, lambda x: F.struct(F.length(x).alias("n"), x.alias("x")))), lambda s: s["x"]), ",")


def street_number(words: Column) -> Column:
    """The first number among the first three words, or an empty string."""
    return F.coalesce(whole_number(F.get(F.filter(F.slice(words, 1, 3), lambda x: x.rlike(NUMBER)), F.lit(0))), F.lit(""))


def _after(words: Column, leads: list[str], pattern: str) -> Column:
    lead = F.array(*map(F.lit, leads))
    hits = F.transform(words, lambda x, i: F.when(F.array_contains(lead, x) & F.get(words, i + 1).rlike(pattern), F.get(words, i + 1)))
    return F.coalesce(F.get(F.filter(hits, lambda x: x.isNotNull()), F.lit(0)), F.lit(""))


def unit_number(words: Column) -> Column:
    return _after(words, UNIT_WORDS, NUMBER)


def building_number(words: Column) -> Column:
    return _after(words, BUILDING_WORDS, "^[A-Za-z0-9]+$")


def postal_code(words: Column) -> Column:
    return F.coalesce(F.get(F.filter(words, lambda x: x.rlike(r"^\p{Nd}{4,6}$")), F.lit(0)), F.lit(""))


NORMALIZED = ("name_norm", "name_ss", "name_tok", "name_num", "name_nchar", "addr_norm", "addr_tok", "addr_num", "addr_nchar", "street_num", "unit_num", "bldg_num", "postal", "has_addr")


def normalize(entities: DataFrame, name: str = "name", address: str = "address") -> DataFrame:
    """Adds the columns of NORMALIZED to an entity table."""
    d = entities.withColumns({"name_norm": normalize_text(F.col(name)), "_addr": normalize_text(F.col(address))})
    d = d.withColumns({"_n": expand(tokens(F.col("name_norm")), NAME_WORDS), "_raw": tokens(F.col("_addr"))})
    d = d.withColumn("_a", expand(F.col("_raw"), ADDRESS_WORDS))
    d = d.withColumns(
        {
            "name_ss": F.array_join(strip_legal(F.col("_n")), " "),
            "name_tok": F.array_join("_n", " "),
            "name_num": number_set(F.col("name_norm")),
            "name_nchar": F.length("name_norm"),
            "addr_norm": F.array_join("_a", " "),
            "street_num": street_number(F.col("_raw")),
            "unit_num": unit_number(F.col("_a")),
            "bldg_num": building_number(F.col("_a")),
            "postal": postal_code(F.col("_a")),
        }
    )
    d = d.withColumns({"addr_tok": F.col("addr_norm"), "addr_num": number_set(F.col("addr_norm")), "addr_nchar": F.length("addr_norm"), "has_addr": F.col("addr_norm") != ""})
    return d.select(*entities.columns, *NORMALIZED)
