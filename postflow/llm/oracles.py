"""DuckDB SQL for the queries of this package that SQL can express."""

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {}

# Windows as text, joined to the windows of documents; a word is hit when a window covers it.
ORACLES["op3_decontaminate"] = f"""
with doc as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w
  from documents),
item as (
  select cast(item_id as varchar) as item_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w
  from benchmark),
need as (
  select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as gram
  from (select *, unnest(range(1, len(w) - k + 2)) as i
        from (select *, least(10, len(w)) as k from item where len(w) > 0))),
sizes as (select distinct k from need),
place as (
  select r, k, i, array_to_string(w[i:i + k - 1], ' ') as gram
  from (select r, k, w, unnest(range(1, len(w) - k + 2)) as i from doc, sizes where len(w) >= k)),
found as (select r, i, p.k, item_id from place p join need n on p.k = n.k and p.gram = n.gram),
hits as (
  select r, count(distinct x) as n_hit
  from (select r, unnest(range(i, i + k)) as x from (select distinct r, i, k from found))
  group by r),
items as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct r, item_id from found) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc left join hits using (r) left join items using (r)
"""

# Prefixes as lists of turns.
ORACLES["op6_chat_format"] = """
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as n,
    struct_pack(r := role, t := text) as x,
    length(regexp_replace(coalesce(role, ''), '<[|](im_start|im_end)[|]>', '<| \\1 |>', 'g'))
      + length(regexp_replace(coalesce(text, ''), '<[|](im_start|im_end)[|]>', '<| \\1 |>', 'g'))
      + length('<|im_start|>') + length('<|im_end|>') + 2 as chars
  from conversations),
prefix as (select conv_id, n, list(x) over (partition by conv_id order by n) as p from turns),
conv as (select conv_id, max(n) as n_turns, sum(chars) as chars from turns group by conv_id),
whole as (select c.*, p from conv c join prefix on c.conv_id is not distinct from prefix.conv_id and n = n_turns),
kept as (
  select min(conv_id) as conv_id, p from whole
  where p not in (select p from prefix join conv on prefix.conv_id is not distinct from conv.conv_id where n < n_turns)
  group by p),
starts as (select p.p, min(k.conv_id) as kept_in from prefix p join kept k on p.conv_id is not distinct from k.conv_id group by p.p)
select w.conv_id, w.n_turns, k.p is not null as kept,
  case when k.p is not null then w.conv_id else s.kept_in end as kept_in,
  case when k.p is not null then cast(w.chars as bigint) else 0 end as n_chars
from whole w left join kept k on w.conv_id is not distinct from k.conv_id join starts s on s.p = w.p
"""

# Checksums byte by byte; near words by the text around the one place where they differ.
ORACLES["op11_spelling_variants"] = rf"""
with recursive bits as (
  select list(c order by i) as crc from (
    select i, list_reduce(list_prepend(cast(i as bigint), range(8)),
      lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) as c
    from (select unnest(range(256)) as i))),
run as (
  select coalesce(cast(doc_id as varchar), '') as d,
    unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run
  from documents),
once as (
  select d, translate(run, '{UPPER}', '{LOWER}') as run, count(*) as n from run where length(run) > 5 group by 1, 2),
code as (select d, run, n, hex(encode(d || ':' || run)) as x from once),
sums as (
  select run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, [cast('0x' || substring(x, 2 * i + 1, 2) as bigint) for i in range(cast(length(x) / 2 as bigint))]),
    lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1]))) as h
  from code, bits),
typed as (
  select n, case when h % 199 = 0
    then substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) else run end as word
  from sums),
words as (
  select word, cast(sum(n) as bigint) as n from typed where length(word) >= 6 group by word having sum(n) >= 5),
less as (
  select word, n, i, substring(word, 1, i) || substring(word, i + 2) as rest
  from (select word, n, unnest(range(length(word))) as i from words)),
pairs as (
  select a.word, b.word as other, b.n as m from less a join less b
    on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select less.word, w.word, w.n from less join words w on less.rest = w.word
  union select w.word, less.word, less.n from less join words w on less.rest = w.word),
best as (
  select word, count(*) as n_near, max(m) as m, min(other) filter (where m = top) as other
  from (select *, max(m) over (partition by word) as top from pairs) group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
    case when m >= 5 * w.n then other end as form, case when m >= 5 * w.n then m end as form_n
  from words w left join best on w.word = best.word),
chain as (
  select word, word as root, form as next from forms
  union all select chain.word, chain.next, forms.form from chain join forms on chain.next = forms.word)
select f.word, form, root, n, n_near, form_n
from forms f join chain on f.word = chain.word and next is null
"""

# All orders walked one document at a time.
ORACLES["op13_filter_audit"] = r"""
with letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
doc as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
first as (select t, min(doc_id) as first_id from doc group by t),
label as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
    max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
fails as (
  select row_number() over () as r, part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    (case when len(w) < 200 then 'A' else '' end)
    || (case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end)
    || (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 'C' else '' end)
    || (case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end)
    || (case when doc.doc_id > first_id then 'E' else '' end) as f
  from doc join first using (t) left join label on doc.doc_id = label.doc_id),
steps as (select filter_order, unnest([1, 2, 3, 4, 5]) as step from orders),
gone as (
  select r, filter_order, min(step) as gone_at
  from fails, steps where contains(f, substring(filter_order, step, 1)) group by r, filter_order),
each as (
  select part, s.filter_order, s.step, substring(s.filter_order, s.step, 1) as letter,
    case when gone_at is null or gone_at > s.step then 1 else 0 end as kept,
    case when gone_at = s.step then 1 else 0 end as removed,
    case when gone_at < s.step and contains(f, substring(s.filter_order, s.step, 1)) then 1 else 0 end as redundant,
    case when f = substring(s.filter_order, s.step, 1) then 1 else 0 end as unique_fails, good, toxic
  from fails cross join steps s
  left join gone on gone.r = fails.r and gone.filter_order = s.filter_order),
rows as (
  select part, filter_order, step, letter,
    cast(sum(kept) as bigint) as kept, cast(sum(removed) as bigint) as removed,
    cast(sum(redundant) as bigint) as redundant, cast(sum(unique_fails) as bigint) as unique_fails,
    cast(sum(removed * good) as bigint) as good_lost, cast(sum(removed * toxic) as bigint) as toxic_lost
  from each group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from rows
"""
