"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from triprollup.llm import feistel, host_rules, line_dedup

#: White space and its absence, as DuckDB's regular expressions write them.
SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
SPACES = "concat(" + ", ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13)) + ")"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_DEDUP = f"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
),
line as (
  select doc_id, unnest(lines) as line, unnest(range(len(lines))) as i from split
),
keyed as (
  select *, translate(trim(line, {SPACES}), '{UPPER}', '{LOWER}') as line_key from line
),
held as (
  select line_key, max(doc_id) as last_doc from keyed
  where length(line_key) >= {line_dedup.MIN_CHARS}
  group by line_key having count(distinct doc_id) >= {line_dedup.MIN_DOCS}
),
judged as (
  select doc_id, line, i, coalesce(doc_id <> last_doc, false) as gone
  from keyed left join held using (line_key)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), ''))
         as kept_sha256
from judged group by doc_id"""

HOST_RULES = f"""
with doc as (
  select doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{WORD}+') as words
  from documents
),
shingle as (
  select doc_id, i,
         array_to_string(words[i:i + {host_rules.WINDOW - 1}], ' ') as shingle
  from (select doc_id, words,
               unnest(range(1, len(words) - {host_rules.WINDOW - 2})) as i from doc) w
),
place as (
  select doc_id, i + unnest(range({host_rules.WINDOW})) as place
  from (select *, count(*) over (partition by doc_id, shingle) as n from shingle) s where n > 1
),
repeated as (
  select doc_id, count(distinct place) as n_repeat_words from place group by doc_id
),
line as (
  select doc_id, unnest(string_split(text, chr(10))) as line from doc
),
doubled as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines
  from line where regexp_matches(line, '{WORD}') group by doc_id
),
measured as (
  select doc_id, source, cast(len(words) as bigint) as n_words,
         cast(length(regexp_replace(text, '{SPACE}+', '', 'g')) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '{host_rules.SYMBOLS}', '', 'g'))
              as bigint) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words
  from doc left join doubled using (doc_id) left join repeated using (doc_id)
),
failing as (
  select *, n_words < {host_rules.MIN_WORDS}
         or n_repeat_words * 100 > n_words * {host_rules.MAX_REPEAT_PERCENT} as base_failed
  from measured
),
host as (
  select source, count(*) as n_docs, count(*) filter (where base_failed) as n_failed
  from failing where source is not null group by source
),
prior as (
  select avg(n_failed / n_docs) as m, var_pop(n_failed / n_docs) as v from host
),
strength as (
  select m, case when v > 0 then greatest(0.0, m * (1 - m) / v - 1)
                 else {host_rules.PRIOR_DOCUMENTS} end as s
  from prior
),
rejected as (
  select source, true as rejected from host, strength
  where (n_failed + m * s) / (n_docs + s) > {host_rules.HOST_LIMIT}
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and rejected is null as kept
from failing left join rejected using (source)"""

# The polynomial of crc32, bits reversed, is a fixed value.
CRC32 = """
crc_step as (
  select b, 0 as k, b as c from (select unnest(range(256)) as b) r
  union all
  select b, k + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end
  from crc_step where k < 8
),
crc_table as (
  select list(c order by b) as entries from crc_step where k = 8
),
crc as (
  select doc_id, cast(strlen(text) + 1 as bigint) as size,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(
             regexp_extract_all(hex(text), '..'),
             lambda h: cast(16 * strpos('123456789ABCDEF', h[1])
                            + strpos('123456789ABCDEF', h[2]) as bigint))),
           lambda c, x: xor(c >> 8, entries[1 + xor(c & 255, x)]))) as text_crc32
  from (select doc_id, coalesce(text, '') as text from documents) d, crc_table
)"""


def _mixed(half: str, size: str) -> str:
    """The round function of one half, within the other's size."""
    mixed = f"(({half} + i % {feistel.ROUNDS} * 7919 + {feistel.SEED}) % {feistel.MODULUS})"
    squared = f"(({mixed} * {mixed} + {feistel.FACTOR}) % {feistel.MODULUS})"
    return f"(({squared} * {feistel.FACTOR} + {mixed}) % {feistel.MODULUS} % {size})"


# i counts rounds. A walk is done once a whole number of networks has led below n.
SHARDING = f"""
with recursive {CRC32},
domain as (
  select n, cast(1 << (bits // 2) as bigint) as upper_size,
         cast(1 << (bits - bits // 2) as bigint) as lower_size
  from (select n, greatest(2, length(ltrim(bin(greatest(n, 1) - 1), '0'))) as bits
        from (select count(*) as n from documents) c) b
),
numbered as (
  select *, row_number() over (order by doc_id nulls first, text_crc32, size) - 1 as number
  from crc
),
walked as (
  select number, number as x, 0 as i from numbered
  union all
  select number,
         case when i % 2 = 0
           then xor(x // lower_size, {_mixed("x % lower_size", "upper_size")}) * lower_size
                + x % lower_size
           else x // lower_size * lower_size
                + xor(x % lower_size, {_mixed("x // lower_size", "lower_size")})
         end,
         i + 1
  from walked, domain where i = 0 or i % {feistel.ROUNDS} <> 0 or x >= n
),
placed as (
  select number, x from walked, domain where i > 0 and i % {feistel.ROUNDS} = 0 and x < n
)
select doc_id, size, text_crc32, 'rows' as law, cast(x % {feistel.SHARDS} as int) as shard,
       x // {feistel.SHARDS} as slot, cast(null as int) as grown_shard
from numbered join placed using (number)"""

ORACLE: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op3_sharding": SHARDING,
    "op8_host_rules": HOST_RULES,
}
