"""SQL for the registered queries that SQL can express, for small tables: each compares everything with everything.

The dialect has lambdas, list slices and RE2 expressions. Words are runs without ASCII white space.
"""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
with recursive docs as (select doc_id, {_WORDS.format(text=_FOLDED)} as w from documents),
shingle as (
    select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from docs where len(w) > 0)
),
size as (select doc_id, count(*) as n from shingle group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id group by all),
link as (select a, b from common join size x on x.doc_id = a join size y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
edge as (select a, b from link union all select b, a from link),
reach as (select doc_id as a, doc_id as b from docs union select r.a, e.b from reach r join edge e on e.a = r.b)
select r.a as doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(r.b) as component_id from reach r left join size on size.doc_id = r.a group by r.a
"""

#: Runs of covered units from the starts of repeated windows (``r``, ``i`` from 0) of a fixed length.
_RUNS = """
again as (select h from starts group by h having count(*) > 1),
hits as (select r, i, case when i - lag(i) over (partition by r order by i) <= {window} then 0 else 1 end as new from starts semi join again using (h)),
runs as (select r, min(i) as a, max(i) + {window} as b from (select *, sum(new) over (partition by r order by i) as run from hits) group by r, run),
gaps as (select r, coalesce(lag(b) over (partition by r order by a), 0) as a, a as b from runs union all select r, max(b), null from runs group by r),
lost as (select r, sum(b - a) as n, count(*) as spans from runs group by r)
"""

SUBSTRINGS = f"""
with docs as (select doc_id, row_number() over () as r, {_WORDS.format(text="coalesce(text, '')")} as w from documents),
starts as (select r, i, md5(array_to_string(w[i + 1:i + 35], ' ')) as h from (select r, w, unnest(range(0, len(w) - 34)) as i from docs where len(w) >= 35)),
{_RUNS.format(window=35)},
kept as (select r, string_agg(t, ' ' order by a) as t from (select r, a, array_to_string(w[a + 1:coalesce(b, len(w))], ' ') as t from gaps join docs using (r)) where t <> '' group by r)
select doc_id, len(w)::bigint as n_words, coalesce(lost.n, 0)::bigint as n_removed,
    sha256(case when lost.n is null then array_to_string(w, ' ') else coalesce(t, '') end) as kept_sha256
from docs left join lost using (r) left join kept using (r)
"""

# Texts are cut into overlapping parts of some thousand digits before their windows are, as a slice costs time up to its end.
BYTES = f"""
with docs as (select doc_id, row_number() over () as r, hex(coalesce(text, '')) as x from documents),
parts as (select r, 1000 * k as base, substr(x, 2000 * k + 1, 2798) as part from (select r, x, unnest(range(0, (length(x) // 2 - 400) // 1000 + 1)) as k from docs where length(x) >= 800)),
starts as (select r, base + j as i, md5(substr(part, 2 * j + 1, 800)) as h from (select r, base, part, unnest(range(0, least(1000, length(part) // 2 - 399))) as j from parts)),
{_RUNS.format(window=400)},
kept as (select r, string_agg(substr(x, 2 * a + 1, 2 * (coalesce(b, length(x) // 2) - a)), '' order by a) as t from gaps join docs using (r) group by r)
select doc_id, (length(x) // 2)::bigint as n_bytes, coalesce(lost.n, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans,
    sha256(unhex(case when lost.n is null then x else t end)) as kept_sha256
from docs left join lost using (r) left join kept using (r)
"""

#: SHA-1 is 40 hexadecimal digits: each five of them are four digits of base 32.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha, {5 * group + 1}, 5))::INT >> {shift}) & 31) + 1, 1)" for group in range(8) for shift in (15, 10, 5, 0)
)
WARC = f"""
with payload as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as sha from pages),
judged as (select *, max(page_id) over (partition by html) as response_id from payload)
select page_id, strlen(html)::bigint as payload_bytes, {_BASE32} as payload_digest,
    case when page_id is not distinct from response_id then 'response' else 'revisit' end as record_type,
    case when page_id is not distinct from response_id then null else response_id end as refers_to
from judged
"""

ORACLES: dict[str, str] = {"op2_ngram_jaccard": JACCARD, "op4_substring_dedup": SUBSTRINGS, "op6_suffix_array_dedup": BYTES, "op13_warc": WARC}
