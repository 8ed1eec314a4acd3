"""Company names and amounts in declarations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import NON_WORD, recode

LT_PER_EUR = 3.45280

# Phrases replaced inside the upper-cased name, in this order.
PHRASES = {
    "VIEŠOJI ĮSTAIGA": "VĮ",
    "UŽDAROJI AKCINĖ BENDROVĖ": "UAB",
    "INDIVIDUALI ĮMONĖ": "IĮ",
    "IND. ĮMONĖ": "IĮ",
    "LIETUVOS RESPUBLIKOS": "LR",
    "JURBARKO FILIALAS": "",
    "VILNIAUS SKYRIUS": "",
    "LIETUVOS FILIALAS": "",
    "LIETUVOS SKYRIUS": "",
    "FILIALAS LIETUVOJE": "",
    "F KAS": "FABRIKAS",
}

# Words left out of a name.
STOPWORDS = ("AB", "UAB", "UADB", "VŠĮ", "LR", "VĮ", "AS", "ASO")

# Names that stand for one company.
SAME_COMPANY = {
    "SEB": "SEB BANKAS",
    "SEB LIZINGAS": "SEB BANKAS",
    "SEB GYVYBĖS DRAUDIMAS": "SEB BANKAS",
    "DNB NORD": "DNB BANKAS",
    "DND BANKAS": "DNB BANKAS",
    "BANKAS DNB NORD": "DNB BANKAS",
    "DNB NORD BANKAS": "DNB BANKAS",
    "DNB LIZINGAS": "DNB BANKAS",
    "SWEDBANK": "SWEDBANK BANKAS",
    "SWEDBANKAS": "SWEDBANK BANKAS",
    "BANKAS SWEDBANK": "SWEDBANK BANKAS",
    "SWEDBANK AUTOPARKO VALDYMAS": "SWEDBANK BANKAS",
    "SWEDBANK LIZINGAS": "SWEDBANK BANKAS",
    "NORDEA": "NORDEA BANKAS",
    "NORDEA BANK": "NORDEA BANKAS",
    "BANKAS NORDEA": "NORDEA BANKAS",
    "NORDEA BANK FINLAND PLC": "NORDEA BANKAS",
    "NORDEA FINANCE LITHUANIA": "NORDEA BANKAS",
    "ŪKIO BANKAS": "ŪKIO BANKAS",
    "ŪKIO BANKO LIZINGAS": "ŪKIO BANKAS",
    "ŠIAULIŲ BANKO LIZINGAS": "ŠIAULIŲ BANKAS",
    "FINASTA LANKSČIOS STRATEGIJOS SUBFONDAS": "FINASTA",
    "FINASTA RUSIJOS TOP20 SUBFONDAS": "FINASTA",
    "UNICREDIT LEASING REG NR 302629475": "UNICREDIT BANKAS",
    "BTA INSURANCE COMPANY SE": "BTA DRAUDIMAS",
    "LUKOIL BALTIJA": "LUKOIL",
    "RIBULE": "RIBULĖ",
    "X": "NEVIEŠINAMA",
}


def clean_company(c: Column) -> Column:
    """Upper case, punctuation out, phrases replaced, stopwords dropped, one name per company."""
    name = F.trim(F.regexp_replace(F.upper(c), NON_WORD, " "))
    for phrase, short in PHRASES.items():
        name = F.replace(name, F.lit(phrase), F.lit(short))
    kept = F.filter(F.split(name, r"\s+"), lambda w: (w != "") & ~w.isin(*STOPWORDS))
    return recode(F.array_join(kept, " "), SAME_COMPANY)


def lt_to_eur(c: Column) -> Column:
    """Litas text to euro; an empty amount stays NULL."""
    return F.nullif(F.trim(c), F.lit("")).cast("double") / F.lit(LT_PER_EUR)
