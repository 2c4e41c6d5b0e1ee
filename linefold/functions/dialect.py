"""The few functions that Spark SQL and DuckDB spell differently.

Plans are written once, as SQL text over these spellings.  The rest of a plan uses
only what both engines agree on.
"""

from __future__ import annotations


class Spark:
    name = "spark"
    double = "double"
    #: Whether a plan may name Arrow kernels.
    kernels = False

    @staticmethod
    def replace(x: str, pattern: str, by: str = "") -> str:
        return f"regexp_replace({x}, r'{pattern}', '{by}')"

    @staticmethod
    def like(x: str, pattern: str) -> str:
        return f"({x} rlike r'{pattern}')"

    @staticmethod
    def first(x: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract({x}, r'{pattern}', {group})"

    @staticmethod
    def count_of(x: str, characters: str) -> str:
        """How many characters of a text are in the class; runs are removed whole."""
        return f"(length({x}) - length(regexp_replace({x}, r'[{characters}]+', '')))"

    @staticmethod
    def once(source: str, **columns: str) -> str:
        """Adds computed columns, each evaluated once a row.

        A filter on a plain alias is pushed below it and repeats its expression at
        every mention; nothing is pushed below a generator's own output.
        """
        fields = ", ".join(f"'{k}', {v}" for k, v in columns.items())
        return f"select * from ({source}) lateral view inline(array(named_struct({fields}))) as {', '.join(columns)}"

    @staticmethod
    def earliest(source: str, keys: str, order: str, payload: str = "") -> str:
        """The first row of each key, as an aggregate: it is combined before the
        shuffle, so a text with very many copies never makes one large window."""
        kept = [c.strip() for c in f"{order}, {payload}".split(",") if c.strip()]
        return f"select {keys}, {', '.join(f'm.{c}' for c in kept)} from (select {keys}, min(struct({', '.join(kept)})) as m from ({source}) group by {keys})"

    @staticmethod
    def running(source: str, group: str, order: str) -> str:
        """Adds ``k``, the row's number within its group, counted over blocks of
        4,096 documents: a group of a third of all rows is not sorted in one task."""
        return Spark._counted(f"select *, cast(doc_id div 4096 as bigint) as block from ({source})", group, order)

    @staticmethod
    def _counted(source: str, group: str, order: str) -> str:
        """Adds ``k`` and the group's size ``n`` to rows with a ``block``, which follows
        ``order`` within the group.

        Both sides of the join need the whole rows (``mark`` is a hash of all columns and
        never exceeds the block's greatest), whatever columns are asked for later: so they
        share one shuffle, and so does a plan that mentions the result twice.
        """
        r = f"with r as (select *, hash(*) as mark from (select *, row_number() over (partition by {group}, block order by {order}) as rn from ({source})))"
        return f"""{r}, c as (select {group} as grp, block as b, max(rn) as m, max(mark) as seen from r group by 1, 2),
          o as (select grp, b, sum(m) over (partition by grp order by b) - m as before, sum(m) over (partition by grp) as n, seen from c)
          select r.*, n, before + rn as k from r join o on r.{group} <=> o.grp and r.block <=> o.b and r.mark <= o.seen"""

    @staticmethod
    def rows(source: str, names: str, values: list[tuple], keep: str = "") -> str:
        """One row for each listed tuple of expressions over the source's row."""
        fields = [n.strip() for n in names.split(",")]
        tuples = ", ".join(f"struct({', '.join(f'{v} as {f}' for v, f in zip(t, fields))})" for t in values)
        return f"select {keep + ', ' if keep else ''}{names} from ({source}) lateral view inline(array({tuples})) as {names}"

    @staticmethod
    def each(source: str, name: str, values: list[str]) -> str:
        """Every row once for each of the listed expressions."""
        return f"select *, explode(array({', '.join(values)})) as {name} from ({source})"

    @staticmethod
    def hash_rank(source: str, group: str, seed: str, key: str = "line_id") -> str:
        """Adds ``k``, the row's place by a digest of its key within its group, and the
        group's size ``n``.  Ranks are counted over 4,096 ranges of the digest, so a
        group of any size is sorted in as many tasks."""
        hashed = f"select *, md5(concat('{seed}|', {key})) as hash, substr(md5(concat('{seed}|', {key})), 1, 3) as block from ({source})"
        return Spark._counted(hashed, group, f"hash, {key}")

    @staticmethod
    def hex_part(x: str, at: int) -> str:
        """Six hexadecimal digits of a text as a number."""
        return f"cast(conv(substr({x}, {at}, 6), 16, 10) as bigint)"

    @staticmethod
    def first_try(key: str, tries: int, holds) -> str:
        """The first number below ``tries`` whose digest with the key fits, or null."""
        digests = f"transform(sequence(0, {tries - 1}), a -> struct(a, md5(concat({key}, '|', cast(a as string))) as h))"
        return f"cast(get(filter({digests}, s -> {holds('s.h')}), 0).a as bigint)"

    @staticmethod
    def cells(table: str, key: str, column: str) -> str:
        """Rows (key, pos from 0, x) of an array column."""
        return f"select {key}, pos, x from {table} lateral view posexplode({column}) as pos, x"

    @staticmethod
    def draw(*parts: str) -> str:
        """A number in [0, 2**32) from a digest of the parts."""
        return f"cast(conv(substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8), 16, 10) as bigint)"

    @staticmethod
    def codepoint(x: str) -> str:
        return f"ascii({x})"

    @staticmethod
    def hexcode(x: str) -> str:
        return f"concat('U+', lpad(hex(ascii({x})), 4, '0'))"

    @staticmethod
    def chars(source: str, columns: str, text: str = "t") -> str:
        """Rows (columns, pos from 1, ch) of every character of a text."""
        return f"select {columns}, pos + 1 as pos, ch from {source} lateral view posexplode(split({text}, '')) as pos, ch where ch <> ''"

    @classmethod
    def frequencies(cls, source: str) -> str:
        """Rows (ch, freq) of the characters of ``source(line_id, t)``."""
        return f"select ch, count(*) as freq from ({cls.chars('(' + source + ')', 'line_id')}) group by ch"

    @staticmethod
    def half_even(x: str, digits: int) -> str:
        return f"bround({x}, {digits})"

    @staticmethod
    def json(x: str, path: str) -> str:
        return f"get_json_object({x}, '{path}')"

    @staticmethod
    def object_of(**fields: str) -> str:
        """A JSON object of named values."""
        return f"to_json(named_struct({', '.join(f'{chr(39)}{k}{chr(39)}, {v}' for k, v in fields.items())}))"

    @staticmethod
    def joined(x: str, order: str, by: str = ",") -> str:
        return f"array_join(transform(array_sort(collect_list(struct({order}, {x} as x))), v -> v.x), '{by}')"

    @staticmethod
    def _alphabet(charset: str) -> str:
        """The vocabulary as one string, so that a character's place is its id; it is
        bounded by the code points there are, and read once as a scalar."""
        return f"(select array_join(transform(array_sort(collect_list(struct(char_id, ch))), v -> v.ch), '') from ({charset}))"

    @classmethod
    def encoded(cls, lines: str, charset: str) -> str:
        ids = "transform(filter(split(t, ''), c -> c <> ''), c -> instr(v, c))"
        return f"select line_id, array_join(ids, ',') as ids, cast(size(ids) as bigint) as label_length from (select line_id, {ids} as ids from (select line_id, t, {cls._alphabet(charset)} as v from ({lines})))"

    @classmethod
    def decoded(cls, lines: str, charset: str) -> str:
        """Whether the text comes back from its ids."""
        ids = "transform(filter(split(t, ''), c -> c <> ''), c -> instr(v, c))"
        return f"select line_id, t = array_join(transform({ids}, i -> substr(v, i, 1)), '') as same from (select line_id, t, {cls._alphabet(charset)} as v from ({lines}))"

    @classmethod
    def from_ids(cls, lines: str, charset: str) -> str:
        """Texts decoded from ids between blanks (0), which decoding drops."""
        ids = "flatten(transform(filter(split(t, ''), c -> c <> ''), c -> array(instr(v, c), 0)))"
        back = "array_join(transform(filter(ids, i -> i <> 0), i -> substr(v, i, 1)), '')"
        return f"select line_id, {back} as back from (select line_id, v, {ids} as ids from (select line_id, t, {cls._alphabet(charset)} as v from ({lines})))"

    @staticmethod
    def pieces(src: str, dst: str, lower: bool, blank: str) -> str:
        if lower:
            src, dst = src[:26].upper() + src, dst[:26] + dst
        return rf"""select doc_id, source, lang, line_no, piece_no, t
          from (select /*spread*/ doc_id, source, lang, text from documents where text is not null)
          lateral view posexplode(split(text, '\n')) as line_no, line
          lateral view posexplode(split(line, r'\. ')) as piece_no, piece
          lateral view explode(array(trim(regexp_replace(translate(piece, '{src}', '{dst}'), r'[{blank}]+', ' ')))) as t"""


class Arrow(Spark):
    """Spark's spelling for registered queries: what is asked of every character goes
    through kernels over Arrow batches, named in comments that ``catalog.query`` resolves."""

    kernels = True

    @staticmethod
    def kernel(name: str, rows: str) -> str:
        """A relation: what the kernel gives for the rows."""
        return f"/*in {name}*/{rows}/*out*/"

    @classmethod
    def pieces(cls, src: str, dst: str, lower: bool, blank: str, *also: str, kept: bool = False) -> str:
        name = " ".join(["kept_lines" if kept else "lines" if lower else "plain_lines", *also])
        return f"select * from {cls.kernel(name, 'select /*spread*/ doc_id, source, lang, text from documents where text is not null')}"

    @staticmethod
    def earliest(source: str, keys: str, order: str, payload: str = "") -> str:
        """Groups by a hash first: the aggregate sorts, and texts share their first bytes."""
        kept = [c.strip() for c in f"{order}, {payload}".split(",") if c.strip()]
        return f"select {keys}, {', '.join(f'm.{c}' for c in kept)} from (select {keys}, min(struct({', '.join(kept)})) as m from ({source}) group by xxhash64({keys}), {keys})"

    @classmethod
    def frequencies(cls, source: str) -> str:
        return f"select ch, sum(n) as freq from {cls.kernel('characters', f'select t from ({source})')} group by ch"

    @classmethod
    def _with_alphabet(cls, kernel: str, lines: str, charset: str) -> str:
        """The kernel keeps the alphabet that the first row of each partition brings."""
        first = "monotonically_increasing_id() % 8589934592 = 0"
        return cls.kernel(kernel, f"select line_id, t, case when {first} then v end as v from (select line_id, t, {cls._alphabet(charset)} as v from ({lines}))")

    @classmethod
    def encoded(cls, lines: str, charset: str) -> str:
        return f"select * from {cls._with_alphabet('encoded', lines, charset)}"

    @classmethod
    def decoded(cls, lines: str, charset: str) -> str:
        """The text goes with the answer."""
        return f"select line_id, same, t from {cls._with_alphabet('decoded', lines, charset)}"

    @classmethod
    def from_ids(cls, lines: str, charset: str) -> str:
        return f"select * from {cls._with_alphabet('from_ids', lines, charset)}"


class Duck(Spark):
    name = "duckdb"

    @staticmethod
    def replace(x: str, pattern: str, by: str = "") -> str:
        return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"

    @staticmethod
    def like(x: str, pattern: str) -> str:
        return f"regexp_matches({x}, '{pattern}')"

    @staticmethod
    def first(x: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract({x}, '{pattern}', {group})"

    @staticmethod
    def count_of(x: str, characters: str) -> str:
        return f"(length({x}) - length(regexp_replace({x}, '[{characters}]+', '', 'g')))"

    @staticmethod
    def once(source: str, **columns: str) -> str:
        return f"select *, {', '.join(f'{v} as {k}' for k, v in columns.items())} from ({source})"

    @staticmethod
    def earliest(source: str, keys: str, order: str, payload: str = "") -> str:
        kept = ", ".join(c for c in (keys, order, payload) if c)
        return f"select {kept} from (select *, row_number() over (partition by {keys} order by {order}) as rn from ({source})) where rn = 1"

    @staticmethod
    def running(source: str, group: str, order: str) -> str:
        return f"select *, row_number() over (partition by {group} order by {order}) as k from ({source})"

    @staticmethod
    def rows(source: str, names: str, values: list[tuple], keep: str = "") -> str:
        fields = [n.strip() for n in names.split(",")]
        tuples = ", ".join(f"row({', '.join(t)})" for t in values)
        picked = ", ".join(f"r[{i}] as {f}" for i, f in enumerate(fields, 1))
        return f"select {keep + ', ' if keep else ''}{picked} from (select *, unnest([{tuples}]) as r from ({source}))"

    @staticmethod
    def each(source: str, name: str, values: list[str]) -> str:
        return f"select *, unnest([{', '.join(values)}]) as {name} from ({source})"

    @staticmethod
    def hash_rank(source: str, group: str, seed: str, key: str = "line_id") -> str:
        return f"select *, row_number() over (partition by {group} order by md5(concat('{seed}|', {key})), {key}) as k, count(*) over (partition by {group}) as n from ({source})"

    @staticmethod
    def hex_part(x: str, at: int) -> str:
        return f"cast('0x' || substr({x}, {at}, 6) as bigint)"

    @staticmethod
    def first_try(key: str, tries: int, holds) -> str:
        return f"list_filter(range(0, {tries}), lambda a: {holds(f'md5(concat({key}, {chr(39)}|{chr(39)}, cast(a as varchar)))')})[1]"

    @staticmethod
    def cells(table: str, key: str, column: str) -> str:
        return f"select {key}, unnest(range(0, len({column}))) as pos, unnest({column}) as x from {table}"

    @staticmethod
    def draw(*parts: str) -> str:
        return f"cast('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) as bigint)"

    @staticmethod
    def codepoint(x: str) -> str:
        return f"unicode({x})"

    @staticmethod
    def hexcode(x: str) -> str:
        return f"concat('U+', lpad(to_hex(unicode({x})), 4, '0'))"

    @staticmethod
    def chars(source: str, columns: str, text: str = "t") -> str:
        return f"select {columns}, pos, cs[pos] as ch from (select *, string_split({text}, '') as cs, unnest(range(1, len(string_split({text}, '')) + 1)) as pos from {source}) where cs[pos] <> ''"

    @staticmethod
    def half_even(x: str, digits: int) -> str:
        return f"round_even({x}, {digits})"

    @staticmethod
    def json(x: str, path: str) -> str:
        return f"json_extract_string({x}, '{path}')"

    @staticmethod
    def object_of(**fields: str) -> str:
        return f"cast(json_object({', '.join(f'{chr(39)}{k}{chr(39)}, {v}' for k, v in fields.items())}) as varchar)"

    @staticmethod
    def joined(x: str, order: str, by: str = ",") -> str:
        return f"string_agg({x}, '{by}' order by {order})"

    @classmethod
    def encoded(cls, lines: str, charset: str) -> str:
        return f"with l as ({lines}), v as ({charset}), c as ({cls.chars('l', 'line_id')}) select c.line_id, {cls.joined('cast(v.char_id as varchar(9))', 'c.pos')} as ids, count(*) as label_length from c join v on c.ch = v.ch group by c.line_id"

    @classmethod
    def decoded(cls, lines: str, charset: str) -> str:
        return f"with l as ({lines}), v as ({charset}), c as ({cls.chars('l', 'line_id')}), b as (select c.line_id, {cls.joined('v.ch', 'c.pos', '')} as back from c join v on c.ch = v.ch group by c.line_id) select l.line_id, l.t = b.back as same from l join b on l.line_id = b.line_id"

    @classmethod
    def from_ids(cls, lines: str, charset: str) -> str:
        return f"with l as ({lines}), v as ({charset}), c as ({cls.chars('l', 'line_id')}) select c.line_id, {cls.joined('v.ch', 'c.pos', '')} as back from c join v on c.ch = v.ch group by c.line_id"

    @staticmethod
    def pieces(src: str, dst: str, lower: bool, blank: str) -> str:
        fold = "translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')" if lower else "piece"
        return rf"""select doc_id, source, lang, line_no, piece_no, trim(regexp_replace(translate({fold}, '{src}', '{dst}'), '[{blank}]+', ' ', 'g')) as t
          from (select doc_id, source, lang, line_no, j - 1 as piece_no, ps[j] as piece
            from (select *, unnest(range(1, len(ps) + 1)) as j
              from (select doc_id, source, lang, i - 1 as line_no, string_split(ls[i], '. ') as ps
                from (select *, unnest(range(1, len(ls) + 1)) as i from (select *, string_split(text, chr(10)) as ls from documents where text is not null)))))"""
