"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE: dict[str, str] = {}

ORACLE["op2_decontamination"] = f"""
with docs as (select doc_id, {WORDS} as words from documents),
items as (select item_id, {WORDS} as words from benchmark),
windows as (
    select distinct item_id, words[s : s + least(10, len(words)) - 1] as win
    from (select item_id, words, unnest(range(1, greatest(2, len(words) - 8))) as s
          from items where len(words) > 0)),
heads as (select distinct win[1] as word, len(win) as n from windows),
starts as (
    select doc_id, unnest(words) as word, generate_subscripts(words, 1) as s from docs),
places as (
    select doc_id, n, s, d.words[s : s + n - 1] as win
    from starts join heads using (word) join docs d using (doc_id)),
hits as (
    select p.doc_id, p.s, p.n, w.item_id from places p join windows w using (win)),
words_hit as (
    select doc_id, count(*) as n_hit
    from (select distinct doc_id, unnest(range(s, s + n)) as at from hits) group by doc_id),
items_hit as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from docs d left join words_hit using (doc_id) left join items_hit using (doc_id)
"""

ORACLE["op4_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


ORACLE["op6_substring_dedup"] = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
places as (
    select doc_id, s, array_to_string(words[s : s + 19], ' ') as win
    from (select doc_id, words, unnest(range(1, len(words) - 18)) as s from docs where len(words) >= 20)),
ranked as (
    select doc_id, s, row_number() over (partition by win order by doc_id, s) as k from places),
gone as (
    select distinct doc_id, unnest(range(s, s + 20)) as at from ranked where k > 1),
words as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as at from docs),
kept as (
    select w.doc_id, count(*) as n, string_agg(word, ' ' order by w.at) as text
    from words w anti join gone g on g.doc_id = w.doc_id and g.at = w.at group by w.doc_id)
select d.doc_id, len(d.words)::bigint as n_words, (len(d.words) - coalesce(k.n, 0))::bigint as n_removed,
    sha256(coalesce(k.text, '')) as kept_sha256
from docs d left join kept k using (doc_id)
"""


def _level(k: int) -> str:
    """Counts and probabilities of the grams of k + 1 characters."""
    base = "1.0 / 256" if k == 0 else "below.p_{x}"
    prob = " ".join(
        f", case when n_{x} + t_{x} > 0 then (l.{x} + t_{x} * {base.format(x=x)}) / (n_{x} + t_{x})"
        f" else {base.format(x=x)} end::double as p_{x}"
        for x in "ab"
    )
    join = f"join p{k - 1} below on below.gram = substr(l.gram, 2)" if k else ""
    return f"""
c{k} as (select right(gram, {k + 1}) as gram, sum(a) as a, sum(b) as b from counts group by 1),
l{k} as (select *, sum(a) over h as n_a, sum(b) over h as n_b,
        count(*) filter (a > 0) over h as t_a, count(*) filter (b > 0) over h as t_b
    from c{k} window h as (partition by left(gram, {k}))),
p{k} as (select l.gram {prob} from l{k} l {join})"""


ORACLE["op10_url_filter"] = (
    r"""
with pages_in as (
    select page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
    from pages),
rules(said, rhost, rpath) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
distinct_urls as (select host, path, count(*) as n from pages_in group by all),
fitting as (
    select host, path, said, rhost || rpath as rule, row_number() over (
        partition by host, path order by length(rhost || rpath) desc) as k
    from distinct_urls join rules
        on (host = rhost or suffix(host, '.' || rhost)) and prefix(path, rpath)),
urls as (
    select u.*, f.rule, f.said, left(md5(u.host || u.path), 1) in ('0', '1', '2', '3') as held
    from distinct_urls u left join fitting f on f.host = u.host and f.path = u.path and f.k = 1),
padded as (select *, repeat(chr(2), 4) || host || path || chr(3) as s from urls),
grams as (
    select host, path, n, said, held, substr(s, i, 5) as gram
    from (select *, unnest(range(1, length(s) - 3)) as i from padded)),
counts as (
    select gram, sum(case when said = 'allow' and not held then n else 0 end) as a,
        sum(case when said = 'block' and not held then n else 0 end) as b
    from grams group by gram),"""
    + ",".join(_level(k) for k in range(5))
    + """,
scored as (
    select host, path, n, said, held, avg(ln(p_a) - ln(p_b)) as score
    from grams join p4 using (gram) group by all),
held as (
    select said, sum(n * score) / sum(n) as mean,
        sqrt(greatest(sum(n * score * score) / sum(n) - (sum(n * score) / sum(n)) ** 2, 0)) as spread
    from scored where said is not null and held group by said),
bound as (
    select case when count(*) < 2 then 0 when sum(spread) = 0 then avg(mean)
        else (max(mean) filter (said = 'allow') * max(spread) filter (said = 'block')
            + max(mean) filter (said = 'block') * max(spread) filter (said = 'allow')) / sum(spread)
        end as t
    from held)
select p.page_id, p.host, p.path, u.rule,
    coalesce(u.said, case when s.score >= (select t from bound) then 'allow' else 'block' end) as verdict
from pages_in p join urls u using (host, path) join scored s using (host, path)
"""
)


ORACLE["op11_collocations"] = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, row_number() over () as id,
        unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
places as (
    select lang, w, unnest(range(1, len(w) + 1)) as s from words),
spans as (
    select lang, unnest([w[s], case when len(w) > s then w[s] || ' ' || w[s + 1] end,
        case when len(w) > s + 1 then w[s] || ' ' || w[s + 1] || ' ' || w[s + 2] end]) as phrase
    from places),
counts as (
    select lang, phrase, count(*) as f, string_split(phrase, ' ') as w
    from spans where phrase is not null group by lang, phrase),
totals as (select lang, sum(f)::bigint as n from counts where len(w) = 1 group by lang),
cuts as (
    select lang, phrase, w, f as a, unnest(range(1, len(w))) as k
    from counts where len(w) > 1 and f >= 10),
cut_scores as (
    select c.*, x.f as l, y.f as r,
        ((1000000::hugeint * a * a) // (x.f::hugeint * y.f))::bigint as score
    from cuts c
    join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[1 : k], ' ')
    join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[k + 1 : len(c.w)], ' ')),
scored as (
    select * from cut_scores
    qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_parts as (
    select lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as phrase
    from scored where len(w) = 3),
covers as (select lang, phrase, max(a) as longer from inner_parts group by lang, phrase),
free as (
    select s.* from scored s left join covers c on c.lang = s.lang and c.phrase = s.phrase and len(s.w) = 2
    where c.longer is null or 100 * c.longer < 50 * s.a),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from free)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

ORACLE["op12_line_dedup"] = r"""
with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
split_up as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as place from docs),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from split_up),
repeated as (
    select key, max(doc_id) as keeper from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3),
marked as (
    select k.*, r.key is not null and k.doc_id <> r.keeper as gone
    from keyed k left join repeated r using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _leaf(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: One level up over a list of nodes, and a checksum of decimal digits, bit by bit.
_PAIRS = "list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))"
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(doc_id::varchar, ''),
        lambda c: [1000 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]))),
    lambda crc, x: case when x > 0 then xor(crc, x - 1000)
        else xor(crc >> 1, (crc & 1) * 3988292384) end))"""

ORACLE["op13_merkle_manifest"] = f"""
with recursive rows_in as (
    select doc_id, coalesce('=' || lang, '') as tree, {_leaf()} as leaf,
        case when {_CRC32} % 7 = 0 then {_leaf("(n_chars + 1)")} else {_leaf()} end as start
    from documents),
leaves as (select *, row_number() over (partition by tree order by doc_id) - 1 as pos from rows_in),
levels as (
    select tree, 0 as level, list(leaf order by pos) as nodes from leaves group by tree
    union all
    select tree, level + 1, {_PAIRS} from levels where len(nodes) > 1),
subroots as (
    select tree, level as height, nodes[1] as subroot, row_number() over (order by tree) - 1 as pos
    from levels where len(nodes) = 1),
top as (
    select 0 as level, list(subroot order by pos) as nodes from subroots
    union all
    select level + 1, {_PAIRS} from top where len(nodes) > 1),
steps as (
    select l.doc_id, t.level as place, (l.pos >> t.level) & 1 as side,
        coalesce(t.nodes[xor(l.pos >> t.level, 1) + 1], '') as sibling
    from leaves l join levels t using (tree) where len(t.nodes) > 1
    union all
    select l.doc_id, s.height + t.level, (s.pos >> t.level) & 1,
        coalesce(t.nodes[xor(s.pos >> t.level, 1) + 1], '')
    from leaves l join subroots s using (tree) cross join top t where len(t.nodes) > 1),
proofs as (
    select doc_id, list({{'side': side, 'sibling': sibling}} order by place) as path,
        sha256(string_agg(sibling, '' order by place)) as proof_sha256
    from steps group by doc_id),
roots as (select nodes[1] as root from top where len(nodes) = 1),
folded as (
    select l.doc_id, l.leaf, s.subroot, r.root, coalesce(p.proof_sha256, sha256('')) as proof_sha256,
        list_reduce(
            list_prepend({{'side': 0::bigint, 'sibling': l.start}}, coalesce(p.path, [])),
            lambda f, x: {{'side': 0::bigint, 'sibling': sha256(
                case x.side when 1 then x.sibling || f.sibling else f.sibling || x.sibling end)}}
        ).sibling as folded_root
    from leaves l join subroots s using (tree) cross join roots r left join proofs p using (doc_id))
select *, folded_root = root as verified from folded
"""
