"""Packing of coded fields into lines, as native SQL array expressions."""

from quartermill.specs.fixed_values import LINE_MARK, LINE_WIDTH, PREFIX_WIDTH

WORKER_PREFIX = f"'{LINE_MARK.ljust(PREFIX_WIDTH)}'"
NO_LINES = "CAST(array() AS ARRAY<STRING>)"


def tax_prefix(jurisdiction_key: str) -> str:
    return f"concat('{LINE_MARK}', {jurisdiction_key})"


# Items packed in one go.  Every step of an aggregate copies its state, so the
# lines closed so far are only touched once per run of items.
RUN = 256


def _state(closed: str, line: str) -> str:
    return f"named_struct('closed', {closed}, 'line', {line})"


_CLOSED = "CASE WHEN s.line = '' THEN s.closed ELSE array_append(s.closed, s.line) END"


def _add_field(prefix: str, text: str, width: int) -> str:
    """State after one more field."""
    return f"""CASE
        WHEN {text} = '' OR {text} IS NULL THEN s
        WHEN s.line <> '' AND startswith(s.line, {prefix}) AND length(s.line) + length({text}) <= {width}
            THEN {_state('s.closed', f'concat(s.line, {text})')}
        ELSE {_state(_CLOSED, f'concat({prefix}, {text})')} END"""


def _in_runs(items: str, step: str) -> str:
    """Lines of ``items``, of which ``step`` is a lambda (s, item) -> s, run by run."""
    run = (
        f"aggregate(slice({items}, p * {RUN} + 1, {RUN}), {_state(NO_LINES, 'all.line')}, {step}, "
        "s -> named_struct('done', array_append(all.done, s.closed), 'line', s.line))"
    )
    return f"""aggregate(sequence(0, greatest(0, (size({items}) - 1) div {RUN})),
        named_struct('done', CAST(array() AS ARRAY<ARRAY<STRING>>), 'line', ''),
        (all, p) -> {run},
        all -> flatten(CASE WHEN all.line = '' THEN all.done ELSE array_append(all.done, array(all.line)) END))"""


def pack(fields: str, prefix: str, width: int = LINE_WIDTH) -> str:
    """Greedy packing of an array of fields into lines with a common prefix.

    A field is never split; NULL and empty fields are left out.  A new line
    starts where the next field would pass ``width``, and a single field longer
    than the line gets an overlong line of its own.
    """
    return _in_runs(fields, f"(s, x) -> {_add_field(prefix, 'x', width)}")


def pack_rows(rows: str, prefix: str, width: int = LINE_WIDTH) -> str:
    """Packing of ``array<struct<text,fields,..>>``, row by row, as one sequence.

    ``prefix`` is SQL over the row ``r``; a change of prefix starts a line.  A
    row whose whole text fits the open line is appended at once, which is what
    adding its fields one by one would give; only the others go field by field.
    """
    # A row's fields start from an empty list of closed lines, as every step copies it.
    fresh = _state(f"CASE WHEN s.line = '' OR startswith(s.line, {prefix}) THEN {NO_LINES} ELSE array(s.line) END",
                   f"CASE WHEN startswith(s.line, {prefix}) THEN s.line ELSE '' END")
    add = f"""CASE
        WHEN x = '' OR x IS NULL THEN t
        WHEN t.line <> '' AND length(t.line) + length(x) <= {width} THEN {_state('t.closed', 'concat(t.line, x)')}
        ELSE {_state(_CLOSED.replace('s.', 't.'), f'concat({prefix}, x)')} END"""
    step = f"""(s, r) -> CASE
            WHEN r.text = '' THEN s
            WHEN startswith(s.line, {prefix}) AND length(s.line) + length(r.text) <= {width}
                THEN {_state('s.closed', 'concat(s.line, r.text)')}
            WHEN NOT startswith(s.line, {prefix}) AND length(r.text) <= {width - PREFIX_WIDTH}
                THEN {_state(_CLOSED, f'concat({prefix}, r.text)')}
            ELSE aggregate(r.fields, {fresh}, (t, x) -> {add}, t -> {_state('concat(s.closed, t.closed)', 't.line')}) END"""
    return _in_runs(rows, step)


# Numbers of lines.  A state is one number: lines opened so far in the upper
# half, the length of the open line (0: none) in the lower.
_LENGTH = 2**32 - 1


def _count_field(width: int) -> str:
    """Step (v, x) -> v of one more field."""
    return f"""(v, x) -> CASE
        WHEN x = '' OR x IS NULL THEN v
        WHEN (v & {_LENGTH}L) > 0 AND (v & {_LENGTH}L) + length(x) <= {width} THEN v + length(x)
        ELSE (v | {_LENGTH}L) + {PREFIX_WIDTH + 1} + length(x) END"""


def count(fields: str, width: int = LINE_WIDTH) -> str:
    """Number of lines that ``pack`` makes of the fields, from their lengths alone."""
    return f"aggregate({fields}, 0L, {_count_field(width)}, v -> shiftright(v, 32))"


def count_rows(rows: str, width: int = LINE_WIDTH) -> str:
    """Number of lines that ``pack_rows`` makes of rows with their jurisdiction key ``juris``."""

    def state(number: str, juris: str = "r.juris") -> str:
        return f"named_struct('v', {number}, 'juris', {juris})"

    step = f"""(s, r) -> CASE
        WHEN r.text = '' THEN s
        WHEN s.juris = r.juris AND (s.v & {_LENGTH}L) + length(r.text) <= {width} THEN {state('s.v + length(r.text)')}
        WHEN s.juris <> r.juris AND length(r.text) <= {width - PREFIX_WIDTH}
            THEN {state(f'(s.v | {_LENGTH}L) + {PREFIX_WIDTH + 1} + length(r.text)')}
        ELSE {state(f"aggregate(r.fields, CASE WHEN s.juris = r.juris THEN s.v ELSE s.v - (s.v & {_LENGTH}L) END, {_count_field(width)})")} END"""
    return f"aggregate({rows}, {state('0L', chr(39) * 2)}, {step}, s -> shiftright(s.v, 32))"


def worker_lines(fields: str) -> str:
    """Employee lines; a worker without fields still gets the bare prefix line."""
    return (
        f"CASE WHEN exists({fields}, f -> f <> '') THEN {pack(fields, WORKER_PREFIX)} "
        f"ELSE array({WORKER_PREFIX}) END"
    )


def count_worker_lines(fields: str) -> str:
    """Number of the employee lines."""
    return f"greatest(1L, {count(fields)})"


def tax_lines(fields: str, jurisdiction_key: str) -> str:
    """Lines of one jurisdiction; no fields, no line."""
    return pack(fields, tax_prefix(jurisdiction_key))


# Two upper-case alphanumerics of which at least one is a letter: a field code.
_CODE_AHEAD = "(?=[A-Z0-9]{2})(?![0-9]{2})"


def rewrap(line: str, width: int = LINE_WIDTH) -> str:
    """Split an already built long line at the last code that still fits.

    The first piece may use the whole width; later pieces carry the employee
    prefix.  Where no code starts inside the window the line is cut hard, so
    every piece makes progress.
    """
    room = width - PREFIX_WIDTH
    first = f"regexp_extract({line}, r'(?s)\\A(?:.{{1,{width - 2}}}{_CODE_AHEAD}|.{{1,{width}}})', 0)"
    rest = f"substring({line}, length({first}) + 1)"
    pieces = (
        f"regexp_extract_all({rest}, r'(?s).{{1,{room}}}\\z|.{{1,{room - 2}}}{_CODE_AHEAD}|.{{1,{room}}}', 0)"
    )
    return (
        f"CASE WHEN coalesce({line}, '') = '' THEN {NO_LINES} "
        f"WHEN length({line}) <= {width} THEN array({line}) "
        f"ELSE concat(array({first}), transform({pieces}, p -> concat({WORKER_PREFIX}, p))) END"
    )
