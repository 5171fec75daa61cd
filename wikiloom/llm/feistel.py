"""Format-preserving Feistel pseudonyms for personal data, in Spark SQL functions only.

A found value is taken apart into symbols, each with a radix (a digit 10, an address octet 256, an area code 800 ...),
and the symbols are permuted by a keyed, alternating Feistel network over the two halves: in each round every symbol of
one half is shifted, modulo its radix, by an HMAC-like SHA-256 of the key, the kind and length, the round, the other
half and its place. Every round can be undone, so the network is a permutation of all values of a format: equal values
get equal pseudonyms in every document, different ones different, and the result is again a valid value of the format.

=========  ==================================================  =================================================
kind       found and validated                                 permuted within
=========  ==================================================  =================================================
card       13 to 19 digits with a valid Luhn sum, also in      same length, grouping and first digit; the check
           groups of four or as 4-6-4 and 4-6-5; the longest   digit is made anew
           valid one in a run of groups
iban       country, check digits, 11 to 30 of A-Z0-9 with      country and letters stay, digits are permuted, the
           remainder 1 modulo 97; in groups of four if it      check digits are made anew
           has the length of its country
phone      +1, 1 or nothing, and ten digits, without +1 in     area and exchange each below 200 or from 200 on, as
           separated groups of 3, 3, 4                         they are; line 0000 to 9999
intl       + and 8 to 15 digits                                calling code, (0) and punctuation stay
national   0 and 8 to 11 digits, with a separator              the zero and punctuation stay
ssn        AAA-GG-SSSS, area 001 to 899 but 666, group and     the same ranges
           serial not zero
ip         four octets 0 to 255                                four octets
date       Y-M-D, Y/M/D, D.M.Y, M/D/Y (D/M/Y if D > 12) of a   the days of the same century; width and order stay;
           real day in 1600 to 2399                            those with a day of the month above 12 and the rest
                                                               apart, so that D/M/Y stays what it is
email      local@domain                                        letters (by case) and digits of the local part
=========  ==================================================  =================================================

Text outside such values is untouched, byte for byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_name

ROUNDS = 10
#: For tests and examples; production names its own secret in this setting. It becomes part of the plan, so clusters that
#: keep plans or event logs should cover it with spark.sql.redaction.string.regex.
DEFAULT_KEY = "wikiloom-example-key"
KEY_SETTING = "spark.wikiloom.pseudonym.key"

# The ITU calling codes of one and two digits (all others have three), and the length of an IBAN by country.
CALLING = "[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR",
    27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_GROUPED_IBAN = "|".join(f"(?:{c})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items())
#: Behind a separator, what is no more of a telephone number unless it would be too short: a card in groups, a date.
_NO_PHONE = r"(?!(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4}|[0-9]{4}-[0-9]{1,2}-[0-9])"
_INTL, _NATIONAL = (rf"(?:(?:{sep}{_NO_PHONE})?{digit}){{{n}}}|(?:{sep}?{digit}){{{n}}}" for sep, digit, n in ((r"[ .-]", r"\(?[0-9]\)?", "7,14"), (r"[ /.-]", r"[0-9]\)?", "7,10")))

#: kind -> pattern. Earlier kinds win where several begin at the same place.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|" + _GROUPED_IBAN,
    "phone": r"\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:1[ .-])?(?:\([0-9]{3}\)[ .-]?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}",
    "intl": rf"\+(?!1[ (.-])[1-9](?:{_INTL})",
    "date": r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}",
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "national": rf"(?=\(|[0-9]{{2,5}}[ /.-])\(?0[1-9](?:{_NATIONAL})",
    "card": r"[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{13,19}",
}
#: A run of groups of digits that may hold cards; _pieces finds them.
_RUN = r"(?:[0-9]{4}[ -])*[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}(?:[ -][0-9]{1,3})?|[0-9]{4}(?:[ -][0-9]{4}){2,}(?:[ -][0-9]{1,3})?|[0-9]{13,19}"
_FIND = PATTERNS | {"card": _RUN}
#: A value stands free: no word character, and no point, slash or dash with a digit, goes on at either side. A time may go on
#: behind a date, and a slash (prefix length, path, end of validity) behind an address or a card.
ANY = (
    r"(?<![A-Za-z0-9_+@%])(?<![0-9][./-])(?:(?:" + "|".join(_FIND.values()) + r")(?![A-Za-z0-9_@])(?![./-][0-9])"
    rf"|(?:{PATTERNS['date']})(?=[Tt][0-9]{{2}})|(?:{PATTERNS['ip']}|{_RUN})(?=/[0-9]))"
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for ``value``, which is written and computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _kind(m: str) -> str:
    """SQL for the kind of a match: the first pattern that is the whole of it and whose values are valid, else ''."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    valid = {
        "email": "true",
        "iban": f"{_mod97(_packed(m))} = 1",
        "phone": "true",
        "intl": f"length({digits}) BETWEEN 8 AND 15",
        "date": f"{_day(m)} IS NOT NULL",
        "ip": f"forall(split({m}, '[.]'), o -> cast(o as int) <= 255)",
        "ssn": f"cast(substr({m}, 1, 3) as int) BETWEEN 1 AND 899 AND substr({m}, 1, 3) <> '666' AND substr({m}, 5, 2) <> '00' AND substr({m}, 8) <> '0000'",
        "national": "true",
        "card": _is_card(m),
    }
    cases = " ".join(f"WHEN regexp_like({m}, {_quoted('^(?:' + p + ')$')}) AND ({valid[k]}) THEN '{k}'" for k, p in PATTERNS.items())
    return f"(CASE {cases} ELSE '' END)"


def _packed(m: str) -> str:
    return f"replace({m}, ' ', '')"


def _is_card(m: str) -> str:
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    return f"length({digits}) BETWEEN 13 AND 19 AND {_luhn(digits)} % 10 = 0"


def _pieces(m: str) -> str:
    """SQL for the array of strings that ``m`` is made of: from left to right, each longest valid card of a run of groups, and the rest.

    A card behind the first group doesn't begin like a year or with 0 or 1, so that tables of years stay.
    """
    shape = _quoted("^(?:" + PATTERNS["card"] + ")$")
    window = "regexp_replace(array_join(slice(t, i, k), ''), '[ -]$', '')"
    card = f"get(filter(transform(array(5, 4, 3), k -> {window}), w -> regexp_like(w, {shape}) AND (i = 1 OR NOT w RLIKE '^(?:[01]|20)') AND {_is_card('w')}), 0)"
    taken = "i + size(split(h, '[ -]'))"
    step = _let(
        card,
        "h",
        f"IF(h IS NULL, named_struct('out', concat(st.out, array(t[i - 1])), 'next', i + 1), "
        f"named_struct('out', concat(st.out, array(h, regexp_extract(t[{taken} - 2], '[ -]$', 0))), 'next', {taken}))",
    )
    run = f"aggregate(sequence(1, size(t)), named_struct('out', cast(array() as array<string>), 'next', 1), (st, i) -> IF(i < st.next, st, {step}), st -> st.out)"
    return f"IF({m} RLIKE '^[0-9]{{4}}[ -][0-9]{{4}}', {_let(f'regexp_extract_all({m}, {chr(39)}[0-9]+[ -]?{chr(39)}, 0)', 't', run)}, array({m}))"


def _luhn(digits: str) -> str:
    """SQL for the Luhn sum: every second digit from the right counts double, less 9 above 9."""
    double = "(cast(c as int) * 2 - IF(c > '4', 9, 0))"
    return f"aggregate(transform(filter(split(reverse({digits}), ''), c -> c <> ''), (c, i) -> IF(i % 2 = 1, {double}, cast(c as int))), 0, (s, x) -> s + x)"


def _mod97(iban: str) -> str:
    """SQL for the remainder of an IBAN: country and check digits go behind, letters count 10 to 35."""
    spun = f"concat(substr({iban}, 5), substr({iban}, 1, 4))"
    return f"aggregate(filter(split({spun}, ''), c -> c <> ''), 0, (s, c) -> IF(c > '9', s * 100 + ascii(c) - 55, s * 10 + cast(c as int)) % 97)"


def _date_parts(m: str) -> str:
    """SQL for struct(y, mo, d, form): form 1 Y-M-D or Y/M/D, 2 D.M.Y or D/M/Y, 3 M/D/Y."""
    a, b, c = (f"cast(p[{i}] as int)" for i in range(3))
    return _let(
        f"split({m}, '[-/.]')",
        "p",
        f"(CASE WHEN {m} RLIKE '^[0-9]{{4}}' THEN struct({a} AS y, {b} AS mo, {c} AS d, 1 AS form) "
        f"WHEN instr({m}, '/') > 0 AND {b} > 12 THEN struct({c} AS y, {a} AS mo, {b} AS d, 3 AS form) "
        f"WHEN instr({m}, '/') > 0 AND {a} <= 12 THEN struct({c} AS y, {a} AS mo, {b} AS d, 3 AS form) "
        f"ELSE struct({c} AS y, {b} AS mo, {a} AS d, 2 AS form) END)",
    )


def _day(m: str) -> str:
    """SQL for the day of a date match; null if there is no such day or the year is out of range."""
    made = "try_to_date(concat(lpad(q.y, 4, '0'), '-', lpad(q.mo, 2, '0'), '-', lpad(q.d, 2, '0')), 'yyyy-MM-dd')"
    return _let(_date_parts(m), "q", f"IF(q.y BETWEEN 1600 AND 2399, {made}, NULL)")


#: Days of a century above the 12th of their month as a product of two radices: 22125 = 75 * 295 if its first year is a leap
#: year, else 22124 = 4 * 5531; the others: 1200 months of 12 days.
_LEAP, _COMMON, _FIRST = (75, 295), (4, 5531), (120, 120)


def _century(day: str) -> str:
    return f"make_date(cast(floor(year({day}) / 100) * 100 as int), 1, 1)"


def _radix(day: str, at: int) -> str:
    return f"CASE WHEN day({day}) <= 12 THEN {_FIRST[at]} WHEN floor(year({day}) / 100) % 4 = 0 THEN {_LEAP[at]} ELSE {_COMMON[at]} END"


def _month(day: str) -> str:
    """SQL for the number of the month in its century, from 0."""
    return f"(year({day}) % 100 * 12 + month({day}) - 1)"


def _place(day: str) -> str:
    """SQL for the number of a day among those of its kind in its century."""
    return f"IF(day({day}) <= 12, {_month(day)} * 12 + day({day}) - 1, datediff({day}, {_century(day)}) - 12 * ({_month(day)} + 1))"


def _placed(day: str, place: str) -> str:
    """SQL for the day of the number ``place`` among those of the kind of ``day``."""
    low = f"make_date(year({_century(day)}) + cast(floor(n / 144) as int), cast(floor(n / 12) % 12 as int) + 1, n % 12 + 1)"
    # a year has 221 or 222 such days: one of two years, and there the last month that begins at or before the place
    begins = "datediff(make_date(z, m, 13), c) - 12 * (z % 100 * 12 + m)"
    year = f"transform(array(year(c) + least(99, cast(floor(n / 221) as int))), z -> IF({begins.replace('m, 13', '1, 13').replace('+ m)', '+ 1)')} <= n, z, z - 1))[0]"
    month = f"aggregate(sequence(1, 12), 1, (b, m) -> IF({begins} <= n, m, b))"
    high = _let(_century(day), "c", _let(year, "z", _let(month, "m", f"make_date(z, m, 13 + n - ({begins}))")))
    return _let(place, "n", f"IF(day({day}) <= 12, {low}, {high})")


def _digit_symbols(text: str) -> str:
    return f"transform(filter(split({text}, ''), c -> c <> ''), c -> struct(cast(c as int) AS v, 10 AS r))"


def _symbols(m: str, kind: str) -> str:
    """SQL for the array of struct(v, r) that is permuted."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    date = _let(_day(m), "e", _let(_place("e"), "n", _let(_radix("e", 1), "q", f"array(struct(cast(floor(n / q) as int) AS v, {_radix('e', 0)} AS r), struct(n % q AS v, q AS r))")))
    local = f"filter(split(substring_index({m}, '@', 1), ''), c -> c RLIKE '[A-Za-z0-9]')"
    return (
        f"(CASE {kind} "
        f"WHEN 'email' THEN transform({local}, c -> CASE WHEN c >= 'a' THEN struct(ascii(c) - 97 AS v, 26 AS r) WHEN c >= 'A' THEN struct(ascii(c) - 65 AS v, 26 AS r) ELSE struct(ascii(c) - 48 AS v, 10 AS r) END) "
        f"WHEN 'iban' THEN {_digit_symbols(f'regexp_replace(substr({m}, 5), {chr(39)}[^0-9]{chr(39)}, {chr(39)}{chr(39)})')} "
        f"WHEN 'phone' THEN concat(array({_office(f'cast(substr({digits}, -10, 3) as int)')}, {_office(f'cast(substr({digits}, -7, 3) as int)')}), {_digit_symbols(f'substr({digits}, -4)')}) "
        f"WHEN 'ssn' THEN array(struct(cast(substr({digits}, 1, 3) as int) - IF(substr({digits}, 1, 3) > '666', 2, 1) AS v, 898 AS r), struct(cast(substr({digits}, 4, 2) as int) - 1 AS v, 99 AS r), struct(cast(substr({digits}, 6) as int) - 1 AS v, 9999 AS r)) "
        f"WHEN 'ip' THEN transform(split({m}, '[.]'), o -> struct(cast(o as int) AS v, 256 AS r)) "
        f"WHEN 'date' THEN {date} "
        f"WHEN 'card' THEN {_digit_symbols(f'substr({digits}, 2, length({digits}) - 2)')} "
        f"ELSE {_digit_symbols(_rest(m))} END)"
    )


def _office(number: str) -> str:
    """SQL for the symbol of an area code or exchange: among those below 200, or those from 200 on."""
    return f"IF({number} < 200, struct({number} AS v, 200 AS r), struct({number} - 200 AS v, 800 AS r))"


#: What stays of a telephone number: the calling code and a (0) behind it, or the zero.
_LEAD = rf"^(?:[+](?:{CALLING})(?:[ .-]?[(]0[)])?|[(]?0)"


def _rest(m: str) -> str:
    """SQL for the digits behind the calling code or the zero."""
    return f"regexp_replace(regexp_replace({m}, '{_LEAD}', ''), '[^0-9]', '')"


def _permuted(key: str, tag: str, symbols: str) -> str:
    """SQL for the permuted values (array of int) of ``symbols``; ``tag`` separates formats."""

    def shifted(own: str, other: str) -> str:
        seen = f"array_join(transform({other}, o -> cast(o.v as string)), ',')"
        inner = f"sha2(concat('{key}', '|i|', {tag}, '|', cast(r as string), '|', cast(i as string), '|', {seen}), 256)"
        word = f"cast(conv(substr(sha2(concat('{key}', '|o|', {inner}), 256), 1, 15), 16, 10) as bigint)"
        return f"transform({own}, (s, i) -> struct(cast(pmod(s.v + {word}, s.r) as int) AS v, s.r AS r))"

    half = "cast(floor(size(syms) / 2) as int)"
    start = f"named_struct('a', slice(syms, 1, {half}), 'b', slice(syms, {half} + 1, size(syms)))"
    step = f"IF(r % 2 = 1, named_struct('a', {shifted('st.a', 'st.b')}, 'b', st.b), named_struct('a', st.a, 'b', {shifted('st.b', 'st.a')}))"
    run = f"aggregate(sequence(1, {ROUNDS}), {start}, (st, r) -> {step}, st -> transform(concat(st.a, st.b), s -> s.v))"
    return f"element_at(transform(array({symbols}), syms -> {run}), 1)"


def _refilled(shape: str, values: str) -> str:
    """SQL for ``shape`` (array of characters) with its digits replaced one by one by the array of digits ``values``."""
    return (
        f"aggregate({shape}, named_struct('out', '', 'i', 0), (st, c) -> IF(c RLIKE '[0-9]', "
        f"named_struct('out', concat(st.out, cast({values}[st.i] as string)), 'i', st.i + 1), named_struct('out', concat(st.out, c), 'i', st.i)), st -> st.out)"
    )


def _chars(text: str) -> str:
    return f"filter(split({text}, ''), c -> c <> '')"


def _spelled(m: str, kind: str, v: str) -> str:
    """SQL for the pseudonym: the format of ``m`` with the permuted values ``v``."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    body = f"concat(substr({digits}, 1, 1), array_join(transform({v}, x -> cast(x as string)), ''))"
    check = f"pmod(10 - {_luhn(f'concat(b, {chr(39)}0{chr(39)})')} % 10, 10)"
    numbers = f"transform({_chars(f'concat(b, cast({check} as string))')}, c -> cast(c as int))"
    card = _let(body, "b", _let(numbers, "w", _refilled(_chars(m), "w")))
    local = (
        f"aggregate({_chars(f'substring_index({m}, {chr(39)}@{chr(39)}, 1)')}, named_struct('out', '', 'i', 0), (st, c) -> CASE "
        f"WHEN c RLIKE '[a-z]' THEN named_struct('out', concat(st.out, char(97 + {v}[st.i])), 'i', st.i + 1) "
        f"WHEN c RLIKE '[A-Z]' THEN named_struct('out', concat(st.out, char(65 + {v}[st.i])), 'i', st.i + 1) "
        f"WHEN c RLIKE '[0-9]' THEN named_struct('out', concat(st.out, cast({v}[st.i] as string)), 'i', st.i + 1) "
        f"ELSE named_struct('out', concat(st.out, c), 'i', st.i) END, st -> st.out)"
    )
    plain = f"concat(substr({m}, 1, 2), '00', b)"
    iban = _let(_refilled(_chars(f"substr({m}, 5)"), v), "b", f"concat(substr({m}, 1, 2), lpad(cast(98 - {_mod97(_packed(plain))} as string), 2, '0'), b)")
    office = lambda at, i: f"lpad(cast(IF(substr({digits}, {at}, 1) < '2', 0, 200) + {v}[{i}] as string), 3, '0')"
    ten = f"concat({office(-10, 0)}, {office(-7, 1)}, array_join(transform(slice({v}, 3, 4), x -> cast(x as string)), ''))"
    one = f"regexp_extract({m}, '^(?:[+]1|1[ .-])?', 0)"
    phone = f"concat({one}, {_refilled(_chars(f'substr({m}, length({one}) + 1)'), f'transform({_chars(ten)}, c -> cast(c as int))')})"
    lead = f"regexp_extract({m}, '{_LEAD}', 0)"
    intl = f"concat({lead}, {_refilled(_chars(f'substr({m}, length({lead}) + 1)'), v)})"
    ssn = f"concat(lpad(cast({v}[0] + IF({v}[0] > 664, 2, 1) as string), 3, '0'), '-', lpad(cast({v}[1] + 1 as string), 2, '0'), '-', lpad(cast({v}[2] + 1 as string), 4, '0'))"
    moved = _let(_day(m), "e", _placed("e", f"cast({v}[0] * ({_radix('e', 1)}) + {v}[1] as int)"))
    form, sep = f"{_date_parts(m)}.form", f"regexp_extract({m}, '[-/.]', 0)"
    two = lambda part: f"lpad(cast({part}(g) as string), 2, '0')"
    date = _let(moved, "g", f"(CASE {form} WHEN 1 THEN concat_ws({sep}, year(g), {two('month')}, {two('day')}) WHEN 2 THEN concat_ws({sep}, {two('day')}, {two('month')}, year(g)) ELSE concat_ws({sep}, {two('month')}, {two('day')}, year(g)) END)")
    return (
        f"(CASE {kind} WHEN 'email' THEN concat({local}, substr({m}, instr({m}, '@'))) WHEN 'iban' THEN {iban} WHEN 'phone' THEN {phone} "
        f"WHEN 'ssn' THEN {ssn} WHEN 'ip' THEN array_join(transform({v}, x -> cast(x as string)), '.') "
        f"WHEN 'date' THEN {date} WHEN 'card' THEN {card} ELSE {intl} END)"
    )


def pseudonym(match: str, key: str = DEFAULT_KEY) -> str:
    """SQL for struct(kind, value) of the SQL expression ``match``: kind '' and the text itself if it is no valid value."""
    tag = "concat(k, ':', cast(size(y) as string), ':', array_join(transform(y, o -> cast(o.r as string)), ','))"
    found = f"element_at(transform(array({_kind(match)}), k -> IF(k = '', struct(k AS kind, {match} AS value), struct(k AS kind, element_at(transform(array({_symbols(match, 'k')}), y -> element_at(transform(array({_permuted(key, tag, 'y')}), v -> {_spelled(match, 'k', 'v')}), 1)), 1) AS value))), 1)"
    return found


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY, found_to: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced; the other columns stay.

    found_to: also an array of struct(kind, value) of what was put in, in order of the text. Null text stays null and has
    no values (an empty array); so does text without such data. Repeated rows stay equal.
    An empty table gives none; whole texts are read, however long.
    """
    if not all(c.isalnum() or c in "-_." for c in key):
        raise ValueError("a key is made of letters, digits, '-', '_' and '.'")
    pattern, text = _quoted(ANY), f"`{text_col}`"
    matches, found = free_name(docs, "__m"), free_name(docs, "__f")
    at = docs.withColumn(matches, F.expr(f"IF({text} RLIKE '[0-9@]', regexp_extract_all({text}, {pattern}, 0), array())"))
    at = at.withColumn(found, F.expr(f"transform(coalesce({matches}, array()), m -> transform({_pieces('m')}, z -> {pseudonym('z', key)}))"))
    glued = f"array_join(zip_with(split({text}, {pattern}, -1), transform({found}, f -> array_join(f.value, '')), (a, b) -> concat(a, coalesce(b, ''))), '')"
    result = at.withColumn(text_col, F.expr(f"IF(exists({found}, f -> exists(f, p -> p.kind <> '')), {glued}, {text})"))
    if found_to:
        result = result.withColumn(found_to, F.expr(f"filter(flatten({found}), f -> f.kind <> '')"))
    return result.select(*docs.columns, *([found_to] if found_to and found_to not in docs.columns else []))


def configured_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, DEFAULT_KEY)


def op5_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, n_values, kinds): each text with pseudonyms, how many, and of what kinds in order."""
    done = pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), key=configured_key(spark), found_to="found")
    return done.select("doc_id", "text", F.size("found").alias("n_values"), F.array_join("found.kind", ",").alias("kinds"))
