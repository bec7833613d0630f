"""PII pseudonyms that keep the format: keyed Feistel permutations, native SQL.

Found and validated: e-mail addresses, IPv4 addresses, dates, social
security numbers, North American and international phone numbers, payment
card numbers (Luhn). A value is replaced by a keyed permutation of all values
of its format, so its pseudonym is again valid, equal values get equal
pseudonyms in every document and partition, and unequal ones never collide:

* numbers: the value as x = l * b + r in a domain of a * b values; rounds
  add a keyed hash of one part to the other, modulo its size. Domains are
  factored exactly, so no value leaves its format. A card's last digit is
  its new check digit.
* dates: day number from 1900-01-01 to 2099-12-31 (73,049 = 17 * 4,297 days).
* e-mail local parts: letters and digits shift within their class by keyed
  hashes of the other half; the domain stays.

A look-alike that fails validation (check digit, calendar, ranges) stays. A
card's digits may run on into a neighbour's (a year, an expiry date, a check
value, a phone), so cards are searched first, from every place, in the usual
layouts and then in any other; those whose check digit is right are matched
as they stand, and digits of failed readings are left to the other formats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plover.llm.common import fresh

ROUNDS = 12
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
BEFORE, AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def _phone_format(stop: str = "") -> str:
    """North American, then international numbers; ``stop``: a lookahead after
    each separator."""
    s = f"[ .-]{stop}"
    return (rf"(?<![\p{{L}}\p{{N}}_+])(?:(?:\+?1(?:{s})?)?(?:\([0-9]{{3}}\) ?|[0-9]{{3}}{s})[0-9]{{3}}{s}[0-9]{{4}}"
            rf"|\+[1-9](?:(?:{s}\(?|\(|\)(?:{s})?)?[0-9]){{7,14}}){AFTER}")


#: Formats by kind, in the order a value's kind is told.
FORMATS = {
    # a repeated group that may give back would recurse once per label in Java; this one keeps what it has
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?<![\p{{L}}\p{{N}}_.]){OCTET}(?:\.{OCTET}){{3}}(?![\p{{L}}\p{{N}}_]|\.[0-9])",
    "date": rf"{BEFORE}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}"
            rf"|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}){AFTER}",
    "ssn": rf"{BEFORE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{AFTER}",
    "phone": _phone_format(),
    "card": rf"(?<![\p{{L}}\p{{N}}_.-])[0-9](?:[ -]?[0-9]){{12,18}}{AFTER}",
}
KINDS = tuple(FORMATS)
#: Usual layouts of cards, searched from every place; then any layout, one after the other.
CARD_LAYOUTS = [rf"(?<![\p{{L}}\p{{N}}_.])(?:{p}){AFTER}" for p in (
    "[0-9]{13,19}", "[0-9]{4}(?:[ -][0-9]{4}){3}", "[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}",
    "[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{3}")]
CARDS = "@cards@"  # the valid cards of a text, in its pattern
STOP = f"(?!(?:{CARDS}){AFTER})"
NUMBERS = "|".join(f"(?:{p})" for k, p in FORMATS.items() if k not in ("email", "card"))
ALL = f"(?:{FORMATS['email']})|{NUMBERS}"
_WITH_CARDS = "|".join([rf"(?:(?<![\p{{L}}\p{{N}}_.])(?:{CARDS}){AFTER})"] + [
    f"(?:{_phone_format(STOP) if k == 'phone' else p})" for k, p in FORMATS.items() if k not in ("email", "card")])


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hash(key: str, kind: str, value: str) -> str:
    """60 bits of a keyed hash of a round (variable i) and a value."""
    return f"cast(conv(substr(sha2(concat({_lit(key + '|' + kind + '|')}, i, '|', {value}), 256), 1, 15), 16, 10) as bigint)"


def feistel(x: str, a: str, b: str, key: str, kind: str) -> str:
    """SQL for the keyed permutation of x in [0, a * b)."""
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('l', cast(({x}) div ({b}) as bigint), "
            f"'r', cast(({x}) % ({b}) as bigint)), (s, i) -> if(i % 2 = 1, "
            f"named_struct('l', (s.l + {_hash(key, kind, 's.r')} % ({a})) % ({a}), 'r', s.r), "
            f"named_struct('l', s.l, 'r', (s.r + {_hash(key, kind, 's.l')} % ({b})) % ({b}))), "
            f"s -> s.l * ({b}) + s.r)")


def _digits(v: str) -> str:
    return f"regexp_replace({v}, '[^0-9]', '')"


def _refill(v: str, digits: str) -> str:
    """The digits in the places of v's digits."""
    return (f"array_join(transform(sequence(1, length({v})), p -> if(substr({v}, p, 1) between '0' and '9', "
            f"substr({digits}, length({_digits(f'substr({v}, 1, p)')}), 1), substr({v}, p, 1))), '')")


def _luhn_sum(d: str, odd: int) -> str:
    """Luhn sum of a digit string; the last digit counts double if odd is 0."""
    digit = f"cast(substr({d}, length({d}) - k, 1) as int)"
    return (f"aggregate(sequence(0, length({d}) - 1), 0, (t, k) -> t + if(k % 2 = {odd}, {digit}, "
            f"2 * {digit} - if({digit} > 4, 9, 0)))")


def _number(d: str, m: str, key: str, kind: str) -> str:
    """Permutation of m digits (a SQL expression) as text."""
    half = f"cast(pow(10, {m} div 2) as bigint)"
    rest = f"cast(pow(10, {m} - {m} div 2) as bigint)"
    return f"lpad(cast({feistel(f'cast({d} as bigint)', half, rest, key, kind)} as string), {m}, '0')"


def _card(key: str) -> str:
    body = "substr(d, 1, length(d) - 1)"
    new = _number(body, "(length(d) - 1)", key, "card")
    check = f"cast((10 - {_luhn_sum('n', 1)} % 10) % 10 as string)"
    with_check = f"transform(array({new}), n -> concat(n, {check}))[0]"
    return (f"transform(array({_digits('v')}), d -> if({_luhn_sum('d', 0)} % 10 = 0, "
            f"{_refill('v', f'({with_check})')}, v))[0]")


def _ip(key: str) -> str:
    x = " + ".join(f"cast(split_part(v, '.', {k + 1}) as bigint) * {256 ** (3 - k)}" for k in range(4))
    return (f"transform(array({feistel(x, '65536', '65536', key, 'ip')}), y -> concat_ws('.', y div 16777216, "
            "y div 65536 % 256, y div 256 % 256, y % 256))[0]")


def _date(key: str) -> str:
    cases = []
    for mark, shape, y, m, d in (("-", "yyyy-MM-dd", 1, 6, 9), (".", "dd.MM.yyyy", 7, 4, 1), ("/", "MM/dd/yyyy", 7, 1, 4)):
        iso = f"concat(substr(v, {y}, 4), '-', substr(v, {m}, 2), '-', substr(v, {d}, 2))"
        day = f"datediff(try_cast({iso} as date), date'1900-01-01')"
        new = feistel("n", "17", "4297", key, "date")
        cases.append(f"when substr(v, {5 if mark == '-' else 3}, 1) = '{mark}' then transform(array({day}), n -> "
                     f"if(n between 0 and 73048, date_format(date_add(date'1900-01-01', cast({new} as int)), '{shape}'), "
                     "v))[0]")
    return f"case {' '.join(cases)} else v end"


def _ssn(key: str) -> str:
    """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999."""
    area, group, serial = "cast(substr(v, 1, 3) as bigint)", "cast(substr(v, 5, 2) as bigint)", "cast(substr(v, 8, 4) as bigint)"
    x = f"(({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1) * 9999 + {serial} - 1"
    back = ("concat_ws('-', lpad(cast(y div 989901 + if(y div 989901 >= 665, 2, 1) as string), 3, '0'), "
            "lpad(cast(y div 9999 % 99 + 1 as string), 2, '0'), lpad(cast(y % 9999 + 1 as string), 4, '0'))")
    return (f"if({area} in (0, 666) or {area} > 899 or {group} = 0 or {serial} = 0, v, "
            f"transform(array({feistel(x, '88902', '9999', key, 'ssn')}), y -> {back})[0])")


def _phone(key: str) -> str:
    """All digits but the country code (a leading 1 before ten digits; two
    digits of an international number)."""
    skip = "(length(d) - if(v like '+%' and not (d like '1%' and length(d) = 11), length(d) - 2, 10))"
    new = _number(f"substr(d, {skip} + 1)", f"(length(d) - {skip})", key, "phone")
    return f"transform(array({_digits('v')}), d -> {_refill('v', f'concat(substr(d, 1, {skip}), {new})')})[0]"


def _email(key: str) -> str:
    """In-place rounds over the two halves of the local part."""
    def pieces(x, size):
        return f"transform(sequence(0, greatest((length({x}) - 1) div {size}, 0)), c -> substr({x}, c * {size} + 1, {size}))"

    def shift(part, other):
        # characters of long parts are reached by pieces (of a multiple of 32), since substr counts from the start
        h = f"sha2(concat({_lit(key + '|email|')}, i, '|', length({part}), '|', {other}), 256)"
        by = "cast(conv(substr(h, 2 * ((p - 1) % 32) + 1, 2), 16, 10) as int)"
        c = "ascii(substr(u, p, 1))"
        moved = " ".join(f"when substr(u, p, 1) between '{lo}' and '{hi}' then chr({ord(lo)} + ({c} - {ord(lo)} + {by}) % {n})"
                         for lo, hi, n in (("0", "9", 10), ("a", "z", 26), ("A", "Z", 26)))
        one = f"array_join(transform(sequence(1, greatest(length(u), 1)), p -> case {moved} else substr(u, p, 1) end), '')"
        return (f"transform(array({h}), h -> array_join(transform({pieces(part, 4096)}, "
                f"q -> array_join(transform({pieces('q', 64)}, u -> {one}), '')), ''))[0]")
    local = "split_part(v, '@', 1)"
    half = f"(length({local}) + 1) div 2"
    return (f"aggregate(sequence(1, {ROUNDS // 2}), named_struct('l', substr({local}, 1, {half}), "
            f"'r', substr({local}, {half} + 1)), (s, i) -> if(i % 2 = 1, named_struct('l', {shift('s.l', 's.r')}, 'r', s.r), "
            f"named_struct('l', s.l, 'r', {shift('s.r', 's.l')})), s -> concat(s.l, s.r, '@', split_part(v, '@', 2)))")


def pseudonym(value: str, kind: str, key: str) -> str:
    """SQL for the pseudonym of a matched value; v is bound to ``value``."""
    made = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}[kind](key)
    return f"transform(array({value}), v -> {made})[0]"


def _kind(value: str) -> str:
    """Kind of a matched value, by the first format that it has on its own."""
    return "case " + " ".join(f"when {value} rlike {_lit('^(?:' + p + ')$')} then '{k}'" for k, p in FORMATS.items()) + " end"


def valid_cards(text: Column) -> Column:
    """The text's cards with a right check digit, joined by |; empty if none.
    Other layouts that hold a card in a usual one are no cards."""
    t = F.coalesce(text, F.lit(""))

    def right(values):
        return F.array_distinct(F.filter(values, lambda v: luhn_sum(v) % 10 == 0))

    usual = right(F.concat(*(F.regexp_extract_all(t, F.lit(f"(?=({p}))"), F.lit(1)) for p in CARD_LAYOUTS)))
    loose = right(F.regexp_extract_all(t, F.lit(FORMATS["card"]), F.lit(0)))
    both = F.transform(F.array(usual), lambda u: F.concat(u, F.filter(
        loose, lambda v: ~F.exists(u, lambda c: F.contains(v, c)))))[0]
    return F.when(t.rlike("[0-9](?:[ -]?[0-9]){12}"), F.array_join(both, "|")).otherwise(F.lit(""))


def luhn_sum(value: Column) -> Column:
    digits = F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), "")
    doubled = F.transform(digits, lambda c, k: F.when(k % 2 == 0, c.cast("int")).otherwise(
        2 * c.cast("int") - F.when(c > "4", 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x)


def _pattern(with_mail: bool, cards: Column) -> Column:
    mail = f"(?:{FORMATS['email']})|" if with_mail else ""
    return F.replace(F.lit(mail + _WITH_CARDS), F.lit(CARDS), cards)


def find_values(text: Column, cards: Column) -> Column:
    """Matched strings of a text, in order, given its ``valid_cards``; texts
    without a digit or @ are not searched for what they can't hold."""
    t = F.coalesce(text, F.lit(""))
    mail = F.contains(t, F.lit("@"))
    return (F.when(mail & (cards != ""), F.regexp_extract_all(t, _pattern(True, cards), F.lit(0)))
            .when(cards != "", F.regexp_extract_all(t, _pattern(False, cards), F.lit(0)))
            .when(mail, F.regexp_extract_all(t, F.lit(ALL), F.lit(0)))
            .when(t.rlike("[0-9][^\\p{L}]*[0-9]"), F.regexp_extract_all(t, F.lit(NUMBERS), F.lit(0)))
            .otherwise(F.expr("cast(array() as array<string>)")))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "pii") -> DataFrame:
    """``docs`` with every validated value of its text replaced, and
    ``found_col`` array<struct<kind, pseudonym, changed>> of the matches in
    order (changed: it was valid). All other columns and rows, repeated ones
    included, stay; null stays null, texts without a match stay as they are.
    Values, ties and very long texts are handled row by row, without a
    shuffle; no pattern gives back a repeated group, so a text's length does not
    deepen the matcher's stack. Input columns keep their names and values, but
    one called ``found_col`` is replaced. A pseudonym has as many code points as
    its value but for IPv4 addresses, whose octets have one to three digits."""
    t, hit, cards = F.col(text_col), fresh(docs, "matches"), fresh(docs, "cards")
    cases = " ".join(f"when x.kind = '{k}' then {pseudonym('x.value', k, key)}" for k in KINDS)
    out = docs.withColumn(cards, valid_cards(t))
    out = out.withColumn(hit, find_values(t, F.col(cards)))
    out = out.withColumn(found_col, F.expr(
        f"transform(transform({hit}, m -> named_struct('kind', {_kind('m')}, 'value', m)), "
        f"x -> named_struct('kind', x.kind, 'value', x.value, 'pseudonym', case {cases} else x.value end))"))
    mail, plain = F.contains(t, F.lit("@")), F.col(cards) == ""
    pieces = (F.when(mail & plain, F.split(t, ALL, -1)).when(plain, F.split(t, NUMBERS, -1))
              .when(mail, F.split(t, _pattern(True, F.col(cards)), -1)).otherwise(F.split(t, _pattern(False, F.col(cards)), -1)))
    joined = F.array_join(F.zip_with(pieces, F.col(found_col), lambda p, x: F.concat(
        p, F.coalesce(x["pseudonym"], F.lit("")))), "")
    out = out.withColumn(text_col, F.when(F.size(hit) > 0, joined).otherwise(t))
    return out.withColumn(found_col, F.transform(found_col, lambda x: F.struct(
        x["kind"].alias("kind"), x["pseudonym"].alias("pseudonym"),
        (x["value"] != x["pseudonym"]).alias("changed")))).drop(hit, cards)
