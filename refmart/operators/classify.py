"""Classification-code decode (inventory C8, C9, PRJ25).

One projection of CASE ladders over the code's fixed positions; the only
aggregate is the per-code name-hint ladder for the ``J`` family (C9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import split_code
from ..functions.predicates import incomplete, min_length
from .measures import flag_ladder

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# --------------------------------------------------------------------------
CATEGORY = {
    "E": "Equity (actions et assimilés)",
    "D": "Debt (instruments de dette)",
    "C": "Collective Investment (OPC/Fonds)",
    "R": "Entitlement / Right (droits)",
    "O": "Listed options (options listées)",
    "F": "Futures (contrats à terme)",
    "S": "Swaps",
    "H": "Hybride / Structuré (non standard / OTC)",
    "M": "Other / Misc (souvent structuré)",
    "J": "Dérivés (famille J - ESMA/FIRDS)",
}
UNKNOWN = "Unknown"
GROUP_BY_LETTER = {
    "E": ({"S": "Shares (actions ordinaires)", "P": "Preferred shares (actions de préférence)",
           "C": "Convertible shares (actions convertibles)"}, "Equity - Autre"),
    "D": ({"B": "Bonds (obligations)", "N": "Notes"}, "Debt - Autre"),
    "C": ({"I": "Fonds / parts (units)", "E": "ETF (Exchange-traded funds)"}, "Collective - Autre"),
}
GROUP_PREFIX = {
    "O": "Option - Groupe ",
    "F": "Forward/Future - Groupe ",
    "S": "Swap - Groupe ",
    "R": "Right - Groupe ",
    "H": "Hybride/Structuré - Groupe ",
    "M": "Other - Groupe ",
}
J_GROUP = {"FX": "Foreign Exchange (change)", "Interest Rate": "Taux d’intérêt (Rates)",
           "Equity": "Actions (Equity)", "Commodity": "Matières premières (Commodities)"}
J_GROUP_OTHER = "J - Autre"
J_TYPE = {"Option": "Option (dérivé)", "Forward": "Forward (dérivé)"}
J_TYPE_OTHER = "Dérivé - Type inconnu"
TYPE_NOT_APPLICABLE = "Non applicable / non renseigné"
TYPE_PREFIX = "Attr1="
DERIVATIVE_LETTERS = ["O", "F", "S", "H", "M", "J"]
EXERCISE_STYLE = {"E": "Européen", "A": "Américain"}
UNDERLYING_BY_CATEGORY = {"E": "Equity", "D": "Debt", "C": "Fund / Collective", "R": "Entitlement",
                          "O": "Derivative", "F": "Derivative", "S": "Derivative", "M": "Other / Structured"}
UNDERLYING_HYBRID = {"E": "Equity", "R": "Interest Rate", "C": "Commodity", "D": "Debt"}
REPORTABLE_LETTERS = ["E", "D", "C", "R", "O", "F", "S", "H", "M", "J"]
# Name-hint ladders for J codes: (LIKE patterns on the upper-cased name, label), first match wins.
UNDERLYING_HINTS = [
    (["%FOREIGN%EXCHANGE%", "%FOREIGN_EXCHANGE%"], "FX"),
    (["%RATES%"], "Interest Rate"),
    (["%EQUITY%"], "Equity"),
    (["%COMMODITIES%"], "Commodity"),
]
TYPE_HINTS = [
    (["%OPTION%"], "Option"),
    (["%FORWARD%", "%FWD%"], "Forward"),
]
# --------------------------------------------------------------------------

DECODED = ["Category", "Group", "Type", "Is_Derivative", "Has_Strike", "Exercise_Style",
           "Underlying_Class", "ESMA_Reportable"]


def _case(c, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def name_hints(listing: DataFrame, underlying_rules=UNDERLYING_HINTS, type_rules=TYPE_HINTS) -> DataFrame:
    """C9 / AGG4: per ``J*`` code, an underlying-class hint and a type hint from the
    instrument names (any name matching a rule sets it; earlier rules win)."""
    j = listing.filter(F.col("CFI").like("J%") & F.col("FullName").isNotNull())
    name = F.upper(F.col("FullName"))
    u = flag_ladder(j, "CFI", name, underlying_rules, UNKNOWN, "Hint_Underlying_Class")
    t = flag_ladder(j, "CFI", name, type_rules, UNKNOWN, "Hint_Derivative_Type")
    return u.join(t, "CFI")


def decode(cfi_col: str = "CFI", hint_u: str = "Hint_Underlying_Class", hint_t: str = "Hint_Derivative_Type"):
    """C8 expressions: {attribute: Column} over a frame with the code and hints."""
    p = split_code(cfi_col)
    cat, grp, a1, a2 = p["cat"], p["grp"], p["a1"], p["a2"]
    hu = F.coalesce(F.col(hint_u), F.lit(UNKNOWN))
    ht = F.coalesce(F.col(hint_t), F.lit(UNKNOWN))

    group = None
    for letter, (sub, other) in GROUP_BY_LETTER.items():
        g = _case(grp, sub, other)
        group = F.when(cat == letter, g) if group is None else group.when(cat == letter, g)
    group = group.when(cat == "J", _case(hu, J_GROUP, J_GROUP_OTHER))
    for letter, prefix in GROUP_PREFIX.items():
        group = group.when(cat == letter, F.concat(F.lit(prefix), grp))
    group = group.otherwise(F.lit(UNKNOWN))

    typ = F.when(cat == "J", _case(ht, J_TYPE, J_TYPE_OTHER)) \
        .when(a1.isNull() | (a1 == ""), F.lit(None).cast("string")) \
        .when(a1 == "X", F.lit(TYPE_NOT_APPLICABLE)) \
        .otherwise(F.concat(F.lit(TYPE_PREFIX), a1))

    underlying = F.when(cat == "H", _case(grp, UNDERLYING_HYBRID, UNKNOWN)) \
        .when(cat == "J", hu)
    for letter, label in UNDERLYING_BY_CATEGORY.items():
        underlying = underlying.when(cat == letter, F.lit(label))
    underlying = underlying.otherwise(F.lit(UNKNOWN))

    return {
        "Category": _case(cat, CATEGORY, UNKNOWN),
        "Group": group,
        "Type": typ,
        "Is_Derivative": F.when(cat.isin(DERIVATIVE_LETTERS), 1).otherwise(0),
        "Has_Strike": F.when(cat == "O", 1).when(cat == "J", F.when(F.col(hint_t) == "Option", 1).otherwise(0))
                       .otherwise(0),
        "Exercise_Style": F.when(cat.isin("O", "H"), _case(a2, EXERCISE_STYLE)),
        "Underlying_Class": underlying,
        "ESMA_Reportable": F.when(cat.isin(REPORTABLE_LETTERS), 1).otherwise(0),
    }


def classify(dim_cfi: DataFrame, hints: DataFrame) -> DataFrame:
    """C8: fill the decoded attributes of classification rows that still miss
    one (FLT6) and whose code has at least 2 characters (FLT5). Other rows are
    returned unchanged. Positional letters ``CFI_1..CFI_6`` are filled too."""
    d = dim_cfi
    for c in DECODED:
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("int" if c in ("Is_Derivative", "Has_Strike", "ESMA_Reportable")
                                                  else "string"))
    todo = F.col("CFI").isNotNull() & min_length("CFI", 2) & incomplete(DECODED)
    j = d.join(hints, "CFI", "left")
    exprs = decode()
    cols = []
    for c in d.columns:
        if c in exprs:
            cols.append(F.when(todo, exprs[c]).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    out = j.select(*cols)
    for i in range(1, 7):
        out = out.withColumn(f"CFI_{i}", F.nullif(F.substring(F.col("CFI"), i, 1), F.lit("")))
    return out
