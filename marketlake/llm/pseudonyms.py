"""Format-preserving pseudonyms of personal data in texts, by DataFrame functions only.

The places where a candidate may start are found by one pattern. Of the forms that fit there, account lengths by country
and phone lengths by country code first, the first valid one counts; where none is, the next place gets its turn. Card numbers by their check digit, bank accounts by their remainder
of 97, addresses and dates by their ranges. A valid value is a pair of whole numbers (x under a, y under b), and a
Feistel network whose round function is a keyed hash permutes such pairs: x takes a hash of y modulo a, then y one of x
modulo b, ten times. The result is written in the value's own layout with its check digits made anew. Equal values get
equal pseudonyms in all documents, different ones different pseudonyms, and whoever has the key can turn them back.
Mail names and secret tokens, which are no numbers, become keyed hashes in their alphabet. A date with slashes is read
as day/month where it can be, so pseudonyms of month/day dates can't all be told apart from those and turned back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
NUMBERS = ("card", "iban", "ssn", "ipv4", "phone", "date", "date_dmy", "date_mdy")  # permuted
HASHED = ("email", "token")

# Days of a whole Gregorian cycle, 1700 to 2099: 146,097 = 189 * 773.
_FIRST_DAY, _DAYS, _DAY_A, _DAY_B = "DATE'1700-01-01'", 146_097, 189, 773
# Social security numbers: areas 001-899 but 666, groups 01-99, serials 0001-9999.
_SSN_A, _SSN_B = 898, 99 * 9_999

# Account lengths by country, and phone digits after the country code where all numbers have as many.
_ACCOUNTS = {
    15: "NO", 16: "BE", 18: "DK FI FO FK GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_PHONES = {
    7: "354", 8: "45 47 65 370 371 852", 9: "27 31 33 34 40 41 48 61 84 351 380 420 421", 10: "1 7 30 44 52 63 90 91 92",
}
# ---- fixed values: country calling codes of two digits; those from 1 and 7 have one, all others three ----
_TWO_DIGIT_CODES = (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92"
    " 93 94 95 98"
)


def _account(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    last = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{last}"


_MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_TOKEN = r"(?<=(?i:token|key|secret|password) ?[=:] ?[\"']?)[0-9a-fA-F]{32,64}(?![0-9A-Za-z])"
_IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
_IBAN_EXACT = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(_account(*a) for a in _ACCOUNTS.items())})(?![\p{{L}}\p{{N}}])"
_PHONE = r"(?<![\p{{L}}\p{{N}}+])\+[0-9]{{1,3}}(?:[ .-]?\(?[0-9]{{2,4}}\)?){{{}}}(?![0-9])"
_PHONE_EXACT = r"(?<![\p{L}\p{N}+])\+(?:" + "|".join(
    rf"(?:{codes.replace(' ', '|')})(?:\)?[ .-]?\(?[0-9]){{{n}}}" for n, codes in _PHONES.items()
) + ")(?![0-9])"
_OTHERS = "|".join([
    r"(?<![\p{L}\p{N}.-])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",  # ipv4
    r"(?<![\p{L}\p{N}/-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9/-])",
    r"(?<![\p{L}\p{N}/-])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/-])",
    r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",  # ssn
    r"(?<![\p{L}\p{N}])(?<![0-9][.])[0-9]{13,19}(?![0-9])",  # card
    r"(?<![\p{L}\p{N}])(?:[0-9]{4}-){3}[0-9]{1,7}(?![0-9-])",
    r"(?<![\p{L}\p{N}])(?:[0-9]{4} ){3}[0-9]{1,7}(?![0-9])",
])
# Where a candidate starts, and what it may be there, the more certain and then the longer one first.
_PATTERN = "|".join([_MAIL, _TOKEN, _IBAN, _PHONE_EXACT, _PHONE.format("2,5"), _OTHERS])
_FORMS = [f"{_MAIL}|{_TOKEN}", _IBAN_EXACT, None, _PHONE_EXACT, *(_PHONE.format(n) for n in (5, 4, 3, 2)), _OTHERS]
_BEFORE = 16  # characters before a start that its pattern may look at
# Starts that a candidate may reach over. Only mail addresses hold more than a few: a name of 64 characters has at most 8
# (an address such as _1.1.1.1 takes eight), a host of 255 characters at most 23 (a date and its break take eleven).
_AFTER = 40


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(digits: str) -> str:
    """Sum of the digits with every second one from the right doubled."""
    at = f"int(substr({digits}, length({digits}) - i + 1, 1))"
    doubled = f"element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), {at} + 1)"
    return f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + IF(i % 2 = 0, {doubled}, {at}))"


def _mod97(plain: str) -> str:
    """Remainder of 97 of letters and digits, a letter being two digits (A is 10)."""
    value = "IF(c RLIKE '[0-9]', ascii(c) - 48, ascii(c) - 55)"
    return f"aggregate(regexp_extract_all({plain}, '.', 0), 0, (r, c) -> (r * IF(c RLIKE '[0-9]', 10, 100) + {value}) % 97)"


def _turned(plain: str) -> str:
    return f"concat(substr({plain}, 5), substr({plain}, 1, 4))"


def _day(date: str) -> str:
    return f"datediff(try_cast({date} AS DATE), {_FIRST_DAY})"


_ISO = "m"
_DMY = "concat_ws('-', substr(m, 7, 4), substr(m, 4, 2), substr(m, 1, 2))"
_MDY = "concat_ws('-', substr(m, 7, 4), substr(m, 1, 2), substr(m, 4, 2))"
_VALID_DAY = f"BETWEEN 0 AND {_DAYS - 1}"
_PLAIN = "regexp_replace(m, '[^0-9A-Z]', '')"
_DIGITS = "regexp_replace(m, '[^0-9]', '')"

def _candidates(at: str) -> str:
    """What the text at a start may be: ``at`` begins ``_BEFORE`` characters earlier.

    An account of a country without a known length is any of its first groups.
    """
    form = lambda p: f"regexp_extract({at}, {_literal(f'^(?s:.{{{_BEFORE}}})({p})')}, 1)"
    known = _literal("^(?:" + "|".join(" ".join(_ACCOUNTS.values()).split()) + ")")
    ends = "filter(reverse(sequence(1, 1 + length(g))), n -> substr(g, n, 1) = ' ')"
    shorter = f"IF(g RLIKE {known}, array(g), array_prepend(transform({ends}, n -> left(g, n - 1)), g))"
    groups = f"transform(array({form(_IBAN)}), g -> {shorter})[0]"
    split_at = _FORMS.index(None)
    first, last = (", ".join(form(p) for p in part) for part in (_FORMS[:split_at], _FORMS[split_at + 1 :]))
    return f"filter(concat(array({first}), {groups}, array({last})), c -> c <> '')"


_KIND = f"""CASE
  WHEN contains(m, '@') THEN 'email'
  WHEN m RLIKE '^[0-9a-fA-F]{{32,64}}$' AND m RLIKE '[a-fA-F]' THEN 'token'
  WHEN m RLIKE '^[A-Z]' THEN IF(length({_PLAIN}) BETWEEN 15 AND 34 AND {_mod97(_turned(_PLAIN))} = 1
                               AND length(substr({_DIGITS}, 3)) >= 2, 'iban', NULL)
  WHEN m RLIKE '^[+]' THEN IF(length({_DIGITS}) BETWEEN 8 AND 15, 'phone', NULL)
  WHEN m RLIKE '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$' THEN
    IF(forall(split(m, '[.]'), o -> int(o) < 256 AND (o = '0' OR o NOT LIKE '0%')), 'ipv4', NULL)
  WHEN m RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' THEN IF({_day(_ISO)} {_VALID_DAY}, 'date', NULL)
  WHEN contains(m, '/') THEN
    CASE WHEN {_day(_DMY)} {_VALID_DAY} THEN 'date_dmy' WHEN {_day(_MDY)} {_VALID_DAY} THEN 'date_mdy' END
  WHEN m RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN
    IF(int(substr(m, 1, 3)) BETWEEN 1 AND 899 AND substr(m, 1, 3) <> '666' AND substr(m, 5, 2) <> '00'
       AND substr(m, 8) <> '0000', 'ssn', NULL)
  WHEN {_luhn(_DIGITS)} % 10 = 0 AND {_DIGITS} RLIKE '[1-9]' THEN 'card'
END"""

# The digits that are permuted: a card's without its check digit, an account's after its check digits, a phone's after
# its country code, with or without a break between them.
_BODY = f"""CASE v.kind
  WHEN 'card' THEN left({_DIGITS.replace("(m,", "(v.m,")}, length({_DIGITS.replace("(m,", "(v.m,")}) - 1)
  WHEN 'iban' THEN substr({_DIGITS.replace("(m,", "(v.m,")}, 3)
  WHEN 'phone' THEN regexp_extract({_DIGITS.replace("(m,", "(v.m,")},
    '^(?:[17]|{_TWO_DIGIT_CODES.replace(" ", "|")}|[0-9]{{3}})([0-9]*)$', 1)
END"""

_ZERO = "bigint(0)"


def _pair(name: str) -> str:
    """x or y of a value; numbers in digits are halved."""
    half = "(length(v.body) + 1) DIV 2"
    part = f"left(v.body, {half})" if name == "x" else f"substr(v.body, 1 + {half})"
    take = {"x": "DIV", "y": "%"}[name]
    octet = "int(split(v.m, '[.]')[{}])"
    address = [octet.format(i) for i in ((0, 1) if name == "x" else (2, 3))]
    area = "int(substr(v.m, 1, 3)) - IF(int(substr(v.m, 1, 3)) > 666, 2, 1)"
    rest = "(int(substr(v.m, 5, 2)) - 1) * 9999 + int(substr(v.m, 8)) - 1"
    days = [f"{_day(d.replace('m', 'v.m') if d == 'm' else d.replace('(m,', '(v.m,'))} {take} {_DAY_B}"
            for d in (_ISO, _DMY.replace("substr(m", "substr(v.m"), _MDY.replace("substr(m", "substr(v.m"))]
    return f"""bigint(CASE v.kind
      WHEN 'ipv4' THEN {address[0]} * 256 + {address[1]}
      WHEN 'ssn' THEN {area if name == "x" else rest}
      WHEN 'date' THEN {days[0]} WHEN 'date_dmy' THEN {days[1]} WHEN 'date_mdy' THEN {days[2]}
      WHEN 'email' THEN 0 WHEN 'token' THEN 0
      ELSE {part} END)"""


def _bound(name: str) -> str:
    digits = "(length(v.body) + 1) DIV 2" if name == "a" else "length(v.body) DIV 2"
    day, ssn = (_DAY_A, _SSN_A) if name == "a" else (_DAY_B, _SSN_B)
    return f"""CASE WHEN v.kind = 'ipv4' THEN bigint(65536) WHEN v.kind = 'ssn' THEN bigint({ssn})
      WHEN v.kind LIKE 'date%' THEN bigint({day}) WHEN v.kind IN ('email', 'token') THEN bigint(1)
      ELSE bigint(rpad('1', 1 + {digits}, '0')) END"""


def _feistel(key: str, back: bool) -> str:
    hashed = "bigint(conv(substr(sha2(concat_ws(':', {key}, {kind}, length(v.body), i, {of}), 256), 1, 15), 16, 10))"
    sign, kind = "-" if back else "+", "IF(v.kind LIKE 'date%', 'date', v.kind)"  # a day is the same in every layout
    x = f"pmod(p.x {sign} {hashed.format(key=key, kind=kind, of='p.y')} % v.a, v.a)"
    y = f"pmod(p.y {sign} {hashed.format(key=key, kind=kind, of='p.x')} % v.b, v.b)"
    order = f"sequence({ROUNDS - 1}, 0)" if back else f"sequence(0, {ROUNDS - 1})"
    return f"""aggregate({order}, named_struct('x', v.x, 'y', v.y),
      (p, i) -> IF(i % 2 = 0, named_struct('x', {x}, 'y', p.y), named_struct('x', p.x, 'y', {y})))"""


def _layout(digits: str) -> str:
    """The digits in the places of the value's digits."""
    before = "length(regexp_replace(left(v.m, n), '[^0-9]', ''))"
    return f"""array_join(transform(regexp_extract_all(v.m, '(?s).', 0),
      (c, n) -> IF(c RLIKE '[0-9]', substr({digits}, 1 + {before}, 1), c)), '')"""


def _written(key: str) -> str:
    half = "(length(v.body) + 1) DIV 2"
    rest = "length(v.body) DIV 2"
    body = f"concat(lpad(string(v.p.x), {half}, '0'), IF({rest} = 0, '', lpad(string(v.p.y), {rest}, '0')))"
    check = f"string((10 - {_luhn(f'concat({body}, {_literal('0')})')} % 10) % 10)"
    # An account: its letters stay, its digits are new, and the check digits follow from both.
    moved = _layout(f"concat('00', {body})")
    remainder = _mod97(_turned(f"regexp_replace({moved}, '[^0-9A-Z]', '')"))
    account = f"concat(left({moved}, 2), lpad(string(98 - {remainder}), 2, '0'), substr({moved}, 5))"
    country = "left(regexp_replace(v.m, '[^0-9]', ''), length(regexp_replace(v.m, '[^0-9]', '')) - length(v.body))"
    day = f"date_add({_FIRST_DAY}, int(v.p.x * {_DAY_B} + v.p.y))"
    area = "v.p.x + IF(v.p.x + 1 >= 666, 2, 1)"
    mail = f"left(translate(sha2(concat_ws(':', {key}, 'email', lower(v.m)), 256), '0123456789', 'ghijklmnop'), 12)"
    token = f"left(sha2(concat_ws(':', {key}, 'token', v.m), 256), length(v.m))"
    return f"""CASE v.kind
      WHEN 'card' THEN {_layout(f"concat({body}, {check})")}
      WHEN 'iban' THEN {account}
      WHEN 'phone' THEN {_layout(f"concat({country}, {body})")}
      WHEN 'ipv4' THEN concat_ws('.', v.p.x DIV 256, v.p.x % 256, v.p.y DIV 256, v.p.y % 256)
      WHEN 'ssn' THEN concat_ws('-', lpad(string({area}), 3, '0'), lpad(string(v.p.y DIV 9999 + 1), 2, '0'),
                                lpad(string(v.p.y % 9999 + 1), 4, '0'))
      WHEN 'date' THEN date_format({day}, 'yyyy-MM-dd')
      WHEN 'date_dmy' THEN date_format({day}, 'dd/MM/yyyy')
      WHEN 'date_mdy' THEN date_format({day}, 'MM/dd/yyyy')
      WHEN 'email' THEN concat({mail}, substr(v.m, instr(v.m, '@')))
      WHEN 'token' THEN IF(v.m = upper(v.m), upper({token}), {token})
      ELSE v.m END"""


def replaced(text: str, key: str, back: bool = False) -> Column:
    """Struct of the new text and the kinds of what was replaced, in order, of a text column's name.

    ``back`` turns permuted values back; hashed ones stay. A null text gives a null struct.
    """
    secret, column = _literal(key), f"`{text}`"
    start = _literal(f"(?={_PATTERN})")
    # A start inside a value before it is none: "over" is how much of that value is still to come there.
    over = "coalesce(int(get(o, i + 1)), 0)"
    reach = """aggregate(v, named_struct('over', 0, 'all', ''), (a, e) -> named_struct(
      'over', greatest(0, IF(a.over > 0, a.over, coalesce(length(e.c.m), 0)) - length(e.s)),
      'all', concat(a.all, ',', string(a.over))))"""
    steps = [
        ("w", f"split({column}, {start}, -1)"),
        ("v", f"transform(w, (s, i) -> named_struct('s', s, 'c', concat(lpad(right(coalesce(get(w, i - 1), ''), {_BEFORE}),"
              f" {_BEFORE}, '\n'), array_join(slice(w, i + 1, {_AFTER}), ''))))"),
        ("v", f"transform(v, v -> named_struct('s', v.s, 'c', {_candidates('v.c')}))"),
        ("v", f"transform(v, v -> named_struct('s', v.s, 'c', get(filter(transform(v.c, m -> "
              f"named_struct('m', m, 'kind', {_KIND})), c -> c.kind IS NOT NULL), 0)))"),
        ("o", f"IF(exists(v, v -> coalesce(length(v.c.m) > length(v.s), false)), split({reach}.all, ','), NULL)"),
        ("v", f"transform(v, (v, i) -> named_struct('m', IF({over} > 0, NULL, v.c.m), 'kind', IF({over} > 0, NULL, v.c.kind),"
              f" 's', substr(v.s, 1 + IF({over} > 0, {over}, coalesce(length(v.c.m), 0)))))"),
        ("v", f"transform(v, v -> named_struct('s', v.s, 'm', v.m, 'kind', v.kind, 'body', {_BODY}))"),
        ("v", "transform(v, v -> named_struct('s', v.s, 'm', v.m, 'kind', v.kind, 'body', v.body, "
              f"'a', IF(v.kind IS NULL, NULL, {_bound('a')}), 'b', IF(v.kind IS NULL, NULL, {_bound('b')}), "
              f"'x', IF(v.kind IS NULL, NULL, {_pair('x')}), 'y', IF(v.kind IS NULL, NULL, {_pair('y')})))"),
        ("v", "transform(v, v -> named_struct('s', v.s, 'm', v.m, 'kind', v.kind, 'body', v.body, "
              f"'p', IF(v.kind IS NULL, NULL, {_feistel(secret, back)})))"),
    ]
    hashed = "v.kind IN ('email', 'token')" if back else "false"
    new = f"IF(v.kind IS NULL OR {hashed}, coalesce(v.m, ''), {_written(secret)})"
    joined = f"array_join(transform(v, v -> concat({new}, v.s)), '')"
    found = "filter(transform(v, v -> v.kind), k -> k IS NOT NULL)"
    result = f"named_struct('text', {joined}, 'kinds', {found})"
    # Each step names its array for the next one: a list of one array is transformed.
    for name, value in reversed(steps):
        result = f"transform(array({value}), {name} -> {result})[0]"
    plain = f"named_struct('text', {column}, 'kinds', CAST(array() AS array<string>))"
    some = _literal("[0-9@]|(?i:token|key|secret|password) ?[=:]")
    return F.expr(f"CASE WHEN {column} RLIKE {some} THEN {result} WHEN {column} IS NOT NULL THEN {plain} END")


def pseudonymise(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """The documents with new texts, and after their columns the kinds of what was replaced.

    Texts without a valid value stay as they are, and so do null and empty ones; numbers that fail their check are not
    touched. Rows are handled one by one, so repeated rows stay equal, and an empty table gives no rows.
    """
    out = docs.withColumn("__llm_new", replaced("text", key, back))
    return out.select(
        *[F.col("__llm_new.text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.col("__llm_new.kinds").alias("__llm_kinds"),
    )
