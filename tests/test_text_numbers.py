from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from innkeep.functions import numbers as N, text as X


@pytest.mark.parametrize(
    "raw, key", [("123.0", "123"), (" 123 ", "123"), ("123.50", "123.50"), ("A1.0", "A1.0"), (None, "")]
)
def test_norm_id(value, raw, key):
    assert value(X.norm_id("a"), a=raw) == key


@pytest.mark.parametrize("raw, text", [("007", "7"), ("A7", "A7"), ("12.0", "12.0"), (None, ""), ("", "")])
def test_id_text(value, raw, text):
    assert value(X.id_text("a"), a=raw) == text


def test_norm_key_ignores_case_and_trailing_blanks(value):
    assert value(X.norm_key("a"), a="Main Office  ") == "main office"
    assert value(X.norm_key("a"), a="CASA SÃO ") == value(X.norm_key("a"), a="Casa Sa\u0303o") == "casa sao"


def test_squeeze_all_kinds_of_space(value):
    assert value(X.squeeze("a"), a="\r\n a   b\tc \n\n") == "a b c"


@pytest.mark.parametrize("raw, kept", [(" ", False), (" ", False), ("x", True)])
def test_non_blank(value, raw, kept):
    assert value(X.non_blank("a"), a=raw) is kept


@pytest.mark.parametrize(
    "title, kept",
    [("Monthly CheckList", False), ("price is c++ (new)", False), ("c plus", True), (None, True)],
)
def test_excluded_phrases(value, title, kept):
    assert value(X.excludes_phrases("a", ["checklist", "C++ (NEW)"]), a=title) is kept


@pytest.mark.parametrize(
    "title, tag",
    [("Fix pump (Pool)", "pool"), ("Fix pump (Pool)  ", "pool"), ("(Pool) fix", None), ("x ()", None), (None, None)],
)
def test_trailing_tag(value, title, tag):
    assert value(X.trailing_tag("a"), a=title) == tag


@pytest.mark.parametrize(
    "tag, who, area",
    [("pool", "ann", "POOL"), ("other", "bob", "GUEST"), (None, "cy", "REPAIR"), ("other", "dee", ""), (None, None, "")],
)
def test_area_from_tag_then_processor(value, tag, who, area):
    rule = X.area("t", "p", {"pool": "POOL"}, [(["bob"], "GUEST"), (["bob", "cy"], "REPAIR")])
    assert value(rule, t=tag, p=who) == area


@pytest.mark.parametrize(
    "name, comment, text",
    [("VIP", "late", "VIP (late)"), ("VIP", " ", "VIP"), ("VIP", None, "VIP"), (None, "late", " (late)")],
)
def test_flag_text(value, name, comment, text):
    assert value(X.flag_text("n", "c"), n=name, c=comment) == text


def test_unit_label_falls_back_to_the_name(value):
    assert value(X.unit_label("n", X.size_label("b", "t")), n="U", b="5", t="4") == "U (5br/4ba)"
    assert value(X.unit_label("n", X.size_label("b", "t")), n="U", b="5", t=None) == "U"


def test_full_name(value):
    assert value(X.full_name("f", "l"), f=None, l="Doe") == "Doe"
    assert value(X.full_name("f", "l"), f="Jo", l=None) == "Jo"


def test_label_rules_apply_in_order(value):
    rules = [(r"^\*?A1 - ", "A1 "), ("A1", "B1")]
    assert value(X.fix_labels("a", rules), a="*A1 - x") == "B1 x"


@pytest.mark.parametrize(
    "raw, number",
    [("12", 12.0), (" 1.5e2 ", 150.0), ("abc", None), ("1.0d", None), ("", None), ("NaN", None), (None, None)],
)
def test_to_number(value, raw, number):
    assert value(N.to_number("a"), a=raw) == number


def test_to_whole_number_accepts_decimal_text(value):
    assert value(N.to_number("a", "bigint"), a="12.0") == 12


@pytest.mark.parametrize(
    "total, nights, rate",
    [("10.01", "2", Decimal("5.01")), ("100", "3", Decimal("33.33")), ("10", "0", None), ("10", None, None), ("x", "2", None)],
)
def test_nightly_rate_rounds_half_away(value, total, nights, rate):
    assert value(N.nightly_rate("t", "n"), t=total, n=nights) == rate


LEAD = {None: ("-", "-"), -5: (0, "1"), 30: (0, "1"), 31: (1, "2"), 60: (1, "2"), 61: (2, "3"), 90: (2, "3"), 120: (3, "4"), 121: (4, "5"), 180: (4, "5"), 181: (None, "6")}


@pytest.mark.parametrize("days", list(LEAD))
def test_lead_bands(value, days):
    label, order = LEAD[days]
    expected = N.LEAD_OVER if label is None else label if days is None else N.LEAD_LABELS[label]
    days_col = F.lit(days).cast("int")
    assert value(N.lead_band(days_col)) == expected
    assert value(N.lead_order(days_col)) == order


@pytest.mark.parametrize(
    "nights, band", [(None, "-"), (3, 0), (4, 1), (5, 1), (6, 2), (7, 2), (8, 3), (10, 3), (11, 4), (15, 4), (16, 5)]
)
def test_stay_bands(value, nights, band):
    labels = (*N.STAY_LABELS, N.STAY_OVER)
    expected = band if band == "-" else labels[band]
    assert value(N.stay_band(F.lit(nights).cast("int"))) == expected


@pytest.mark.parametrize(
    "code, door",
    [("1234", "1234#"), ("0", "9"), ("", "9"), ("abc", "9"), (None, "9"), ("-5", "9"), ("NaN", "9")],
)
def test_door_code(value, code, door):
    assert value(N.code_or("c", "f"), c=code, f="9") == door


@pytest.mark.parametrize(
    "new, base, ok", [(105, 100, True), (106, 100, False), (99, 100, False), (0, 0, True), (1, 0, False)]
)
def test_row_growth_limits(value, new, base, ok):
    assert value(N.grew_within(F.lit(new), F.lit(base), 0.05)) is ok


@pytest.mark.parametrize(
    "new, base, ok",
    [("110", "100", True), ("90", "100", True), ("110.01", "100", False), ("89.99", "100", False), ("0", "0", True), ("1", "0", False)],
)
def test_sum_drift_limits(value, new, base, ok):
    money = lambda text: F.lit(text).cast("decimal(18,2)")
    assert value(N.drifts_within(money(new), money(base), 0.10)) is ok


def test_drift(value):
    assert value(N.drift(F.lit(110.0), F.lit(100.0))) == pytest.approx(0.1)
    assert value(N.drift(F.lit(1.0), F.lit(0.0))) is None
