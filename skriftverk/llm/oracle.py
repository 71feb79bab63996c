"""SQL twins of the pN_ queries where SQL can say the same on whole tables."""

from __future__ import annotations

#: Words of a text, as in the library: maximal runs of letters and numbers, lower-cased.
WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


def oracle_sql() -> dict[str, str]:
    grams = f"""w as (select doc_id, {WORDS} as w from documents where text is not null),
      g as (select doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] as s
            from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from w where len(w) >= 5))"""
    return {
        "p4_found": f"""with {grams}, s as (select distinct doc_id, s from g), n as (select doc_id, count(*) as n from s group by 1),
          j as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2)
          select a as doc_id_a, b as doc_id_b from j join n x on x.doc_id = a join n y on y.doc_id = b
          where c * 100 >= 72 * (x.n + y.n - c)""",
        "p6_found": f"""with {grams}, r as (select doc_id, i, row_number() over (partition by doc_id, s order by i) as k from g),
          c as (select doc_id, count(distinct p) as c from (select doc_id, unnest(range(i, i + 5)) as p from r where k > 1) group by 1)
          select doc_id from c join w using (doc_id) where c >= 0.3 * len(w)""",
        "p9_found": f"""with b as (select item_id, {WORDS} as w from benchmark where text is not null),
          t as (select item_id, least(12, len(w)) as n, w from b where len(w) >= 8),
          p as (select distinct item_id, n, array_to_string(w[i:i+n-1], ' ') as s from (select *, unnest(range(1, len(w) - n + 2)) as i from t)),
          d as (select doc_id, {WORDS} as w from documents where text is not null),
          l as (select distinct n from t),
          q as (select distinct doc_id, n, array_to_string(w[i:i+n-1], ' ') as s from (select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as i from d, l where len(w) >= n))
          select distinct doc_id, item_id from q join p using (n, s)""",
    }
