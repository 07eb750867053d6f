"""Fixed-width field formats as native SQL expressions.

The builders take and return SQL expression text, because formats are generated
from specification rows; use them with ``selectExpr`` or ``F.expr``.  Each
``*_field`` yields ``code + value`` and NULL for a NULL value, so absent fields
drop out when a line is packed.  An empty string is a value and comes out as
padding.  ``code`` and ``width`` are SQL text too, so they may be columns.
"""

# Characters that an overlong name keeps in front of and behind its mark.
NAME_CHARACTERS = 20


def quote(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def trimmed(value: str) -> str:
    return f"trim(CAST({value} AS STRING))"


def text_field(code: str, value: str, width: int | None, pad: str = "right") -> str:
    """Text cut or padded to ``width``; no width keeps the trimmed text."""
    text = trimmed(value)
    if width and width > 0:
        # lpad and rpad cut an overlong value to its first characters.
        text = f"{'lpad' if pad == 'left' else 'rpad'}({text}, {width}, ' ')"
    return f"concat({code}, {text})"


def identity_field(code: str, value: str) -> str:
    """Nine digits become NNN-NN-NNNN; anything else stays as it is."""
    text = trimmed(value)
    digits = f"regexp_replace({text}, '[^0-9]', '')"
    dashed = f"regexp_replace({digits}, '^(...)(..)(....)$', '$1-$2-$3')"
    return f"concat({code}, CASE WHEN length({digits}) = 9 THEN {dashed} ELSE {text} END)"


def overflow_field(code: str, value: str, width: int, mark: str, head: int) -> str:
    """Names longer than ``width``: ``head`` characters, the mark, then the rest."""
    text = trimmed(value)
    tail = NAME_CHARACTERS - head
    split = f"concat(left({text}, {head}), {quote(mark)}, rpad(substring({text}, {head + 1}, {tail}), {tail}, ' '))"
    return f"concat({code}, CASE WHEN length({text}) <= {width} THEN rpad({text}, {width}, ' ') ELSE {split} END)"


def sign_of(value: str) -> str:
    return f"CASE WHEN {value} >= 0 THEN '+' ELSE '-' END"


def number_field(code: str, value: str, width: int, signed: bool) -> str:
    """Whole number, zero-padded; the sign takes one position."""
    if signed:
        return f"concat({code}, {sign_of(value)}, lpad(CAST(abs({value}) AS STRING), {width - 1}, '0'))"
    return f"concat({code}, lpad(CAST({value} AS STRING), {width}, '0'))"


def scaled(value: str, decimals: int) -> str:
    """Implied-decimal integer, extra digits cut off."""
    shifted = f"{value} * {10**decimals}" if decimals else value
    return f"CAST({shifted} AS BIGINT)"


def decimal_field(code: str, value: str, width: int, decimals: int, signed: bool) -> str:
    if signed:
        digits = f"CAST({scaled(f'abs({value})', decimals)} AS STRING)"
        return f"concat({code}, {sign_of(value)}, lpad({digits}, {width - 1}, '0'))"
    return f"concat({code}, lpad(CAST({scaled(value, decimals)} AS STRING), {width}, '0'))"


def date_field(code: str, value: str, pattern: str) -> str:
    return f"concat({code}, date_format({value}, {quote(pattern)}))"


def amount_digits(value: str, decimals: int) -> str:
    return f"CAST({scaled(f'abs({value})', decimals)} AS STRING)"


def amount_field(code: str, value: str, width: str, mandatory: str, decimals: int) -> str:
    """Signed amount of a tax row.

    Absent (NULL) without a code or a value; a zero is absent unless the code
    is mandatory.
    """
    digits = f"lpad({amount_digits(value, decimals)}, {width} - 1, '0')"
    return (
        f"CASE WHEN {value} <> 0 OR coalesce({mandatory}, false) "
        f"THEN concat({code}, {sign_of(value)}, {digits}) END"
    )


def amount_overflows(value: str, width: str, decimals: int) -> str:
    """True when the digits of an amount do not fit, so the field was cut."""
    return f"length({amount_digits(value, decimals)}) > {width} - 1"


def flag_text_field(code: str, value: str, width: int = 1) -> str:
    return f"concat({code}, rpad({trimmed(value)}, {width}, ' '))"


def count_field(code: str, value: str, width: int = 2) -> str:
    return f"concat({code}, lpad(CAST(CAST({value} AS BIGINT) AS STRING), {width}, '0'))"


def place_field(code: str, value: str, width: int = 6) -> str:
    """Lived-in place: blank or NULL is absent."""
    return f"CASE WHEN trim({value}) <> '' THEN concat({code}, lpad(trim({value}), {width}, '0')) END"


def zero_text(width: str, signed: str) -> str:
    """Default value of a field: zeros, led by a plus sign when signed."""
    return f"CASE WHEN {signed} THEN concat('+', repeat('0', {width} - 1)) ELSE repeat('0', {width}) END"
