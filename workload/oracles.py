"""The same results in DuckDB's SQL, written against the given tables.

Queries are put together from the fragments below; each fragment is a chain of
common table expressions.
"""

from __future__ import annotations

from turnmill import config
from turnmill.functions.overlap import BLEU_RULES
from turnmill.functions.text import WHITESPACE
from workload.fixtures import TAIL, TAIL_MARKERS

SYSTEM = config.SYSTEM_PROMPT
WHITESPACE_RUN = f"[{WHITESPACE}]+"


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {q(WHITESPACE)})"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {q(WHITESPACE_RUN)}), lambda w: w <> '')"


def normalize(x: str) -> str:
    return f"regexp_replace({strip(f'lower({x})')}, {q(WHITESPACE_RUN)}, ' ', 'g')"


def blank(x: str) -> str:
    return f"coalesce({strip(x)} = '', true)"


# --- inputs -----------------------------------------------------------------

PAIRS = """pairs as (
  select concat(conv_id, '-', turn) as row_id, text as instruction, next_text as response,
         concat('intent_', conv_id % 7) as intent, concat('CAT_', conv_id % 3) as category,
         conv_id * 31 + turn as k
  from (select *, lead(role) over (partition by conv_id order by turn) as next_role,
               lead(text) over (partition by conv_id order by turn) as next_text
        from conversations)
  where role = 'user' and next_role = 'assistant')"""

DIRTY = PAIRS + f""", dirty as (
  select row_id,
         case k % 11 when 0 then null when 1 then '   ' when 2 then ' Hi '
              else concat('  ', instruction, ' ') end as instruction,
         case when k % 13 <> 5 then concat(response, {q(TAIL)}, '{{{{',
              [{', '.join(q(m) for m in TAIL_MARKERS)}][k % 9 + 1], '}}}}') end as response,
         intent, category
  from pairs
  union all
  select row_id || '-copy', lower(instruction), response, intent, category from pairs)"""

NONBLANK = DIRTY + f""", nonblank as (
  select * from dirty where not {blank('instruction')} and not {blank('response')})"""


def replaced(x: str, column: str, static=None, numbers=None, pools=None) -> str:
    static, numbers, pools = static or {}, numbers or {}, pools or {}
    names = "|".join([*static, *numbers, *pools])
    h = (f"(('0x' || substr(md5(concat_ws('|', '42', row_id, '{column}', "
         f"names[i - 1], i - 1)), 1, 8))::bigint)")
    cases = [f"when {q(n)} then {q(v)}" for n, v in static.items()]
    cases += [f"when {q(n)} then concat({q(p)}, {lo} + {h} % {hi - lo + 1})"
              for n, (p, lo, hi) in numbers.items()]
    cases += [f"when {q(n)} then [{', '.join(q(v) for v in vs)}][{h} % {len(vs)} + 1]"
              for n, vs in pools.items()]
    parts = f"string_split_regex({x}, '\\{{\\{{(?:{names})\\}}\\}}')"
    found = f"regexp_extract_all({x}, '\\{{\\{{({names})\\}}\\}}', 1)"
    body = f"case when i = 1 then p else concat(case names[i - 1] {' '.join(cases)} end, p) end"
    # names is bound by an inner select, so that the lambda sees a plain column.
    return (f"(select array_to_string(list_transform(parts, lambda p, i: {body}), '') "
            f"from (select {found} as names, {parts} as parts))")


def leftover(x: str) -> str:
    return f"regexp_replace({x}, {q(config.LEFTOVER_PATTERN)}, {q(config.LEFTOVER_TEXT)}, 'g')"


def spaces(x: str) -> str:
    return f"regexp_replace({x}, '  +', ' ', 'g')"


def punct(x: str) -> str:
    return f"regexp_replace({x}, ' ([.,;:!?])', '\\1', 'g')"


def clean(x: str, column: str) -> str:
    known = replaced(strip(x), column, config.STATIC_MARKERS, config.NUMBER_MARKERS, config.POOL_MARKERS)
    return strip(punct(spaces(leftover(known))))


CLEANED = NONBLANK + f""", cleaned as (
  select row_id, {clean('instruction', 'instruction')} as instruction,
         {clean('response', 'response')} as response, intent, category from nonblank)"""

REASON = f"""case when {blank('instruction')} or {blank('response')} then 'empty'
     when length({strip('instruction')}) < 5 then 'too_short'
     when {len(SYSTEM)} + length(instruction) + length(response) > 950 then 'too_long' end"""

DEDUPED = CLEANED + f""", deduped as (
  select * from cleaned qualify row_number() over (
    partition by lower({strip('instruction')}) order by md5('42|' || row_id), row_id) = 1)"""

CURATED = DEDUPED + f""", curated as (select * from deduped where ({REASON}) is null)"""


def split_of(source: str, row_id: str) -> str:
    """CTEs giving every row of ``source`` its rank, its split and its rank inside."""
    return f""", ranked as (
  select *, md5('43|' || {row_id}) as split_order,
         row_number() over (order by md5('43|' || {row_id}), {row_id}) as pos,
         ceil(0.2 * count(*) over ()) as holdout
  from {source}), split_rows as (
  select * exclude (pos, holdout),
         case when pos <= ceil(0.5 * holdout) then 'test'
              when pos <= holdout then 'validation' else 'train' end as split
  from ranked), ordered as (
  select *, row_number() over (partition by split order by split_order, {row_id}) as split_pos
  from split_rows)"""


SPLIT = CURATED + split_of("curated", "row_id")

PREDICTIONS = PAIRS + """, predictions as (
  select row_id, instruction as prompt, response as reference,
         array_to_string(w[1:ceil(len(w) * 0.5)::int], ' ') as baseline,
         case when k % 7 = 0 then concat(' ', lower(response))
              else array_to_string(w[1:ceil(len(w) * 0.8)::int], ' ') end as fine_tuned,
         case when k % 17 = 3 then null when k % 19 = 4 then '' else intent end as intent,
         category,
         (k % 97) / 10.0::double as baseline_sec, (k % 89) / 10.0::double as fine_tuned_sec,
         (k % 89) / 100.0::double as baseline_semantic_f1,
         (k % 83) / 100.0::double as fine_tuned_semantic_f1
  from (select *, list_filter(string_split_regex(response, '\\s+'), lambda x: x <> '') as w from pairs))"""

ANSWERS = PREDICTIONS + """, answers as (
  select row_id, intent, 'baseline' as model, baseline as answer, reference,
         baseline_sec as sec, baseline_semantic_f1 as semantic from predictions
  union all
  select row_id, intent, 'fine_tuned', fine_tuned, reference,
         fine_tuned_sec, fine_tuned_semantic_f1 from predictions)"""

# The published patterns of the mteval-13a tokeniser.
BLEU_PATTERNS = (
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "),
    (r"([^0-9])([\.,])", r"\1 \2 "),
    (r"([\.,])([^0-9])", r" \1 \2"),
    (r"([0-9])(-)", r"\1 \2 "),
)

# --- scores -----------------------------------------------------------------


def bleu_tokens(x: str) -> str:
    for old, new in BLEU_RULES:
        x = f"replace({x}, {q(old)}, {q(new)})"
    x = f"concat(' ', {x}, ' ')"
    for pattern, replacement in BLEU_PATTERNS:
        x = f"regexp_replace({x}, {q(pattern)}, {q(replacement)}, 'g')"
    return words(x)


def rouge_tokens(x: str) -> str:
    return f"list_filter(string_split_regex(lower({x}), '[^a-z0-9]+'), lambda w: w <> '')"


TOKENS = ANSWERS + f""", tokens as (
  select row_id, intent, model, {rouge_tokens('answer')} as a, {rouge_tokens('reference')} as r,
         {bleu_tokens('answer')} as ba, {bleu_tokens('reference')} as br from answers)"""


def overlaps(name: str, a: str, r: str, orders) -> str:
    """CTEs counting shared n-grams per answer: explode, count, join, take the lesser."""
    parts = []
    for side, column in (("a", a), ("r", r)):
        grams = "\n  union all ".join(
            f"select row_id, model, {n} as n, unnest(list_transform(range(1, len({column}) - {n - 2}), "
            f"lambda i: array_to_string({column}[i:i + {n - 1}], ' '))) as gram from tokens"
            for n in orders
        )
        parts.append(f", {name}_{side} as (select row_id, model, n, gram, count(*) as c "
                     f"from ({grams}) group by all)")
    parts.append(
        f", {name} as (select x.row_id, x.model, x.n, sum(least(x.c, y.c))::bigint as hits "
        f"from {name}_a x join {name}_r y using (row_id, model, n, gram) group by all)"
    )
    return "".join(parts)


ROUGE_N = TOKENS + overlaps("shared", "a", "r", (1, 2))
BLEU_N = overlaps("bleu_shared", "ba", "br", (1, 2, 3, 4))


def f_score(hits: str, a: str, r: str) -> str:
    return (f"case when coalesce({hits}, 0) = 0 then 0::double else "
            f"2 * ({hits}::double / ({a})) * ({hits}::double / ({r})) "
            f"/ ({hits}::double / ({a}) + {hits}::double / ({r})) end")


ROUGE_SCORES = ROUGE_N + f""", rouge as (
  select t.row_id, t.intent, t.model,
         {f_score('s1.hits', 'len(a)', 'len(r)')} as rouge1,
         {f_score('s2.hits', 'len(a) - 1', 'len(r) - 1')} as rouge2
  from tokens t
  left join shared s1 on s1.row_id = t.row_id and s1.model = t.model and s1.n = 1
  left join shared s2 on s2.row_id = t.row_id and s2.model = t.model and s2.n = 2)"""

# Longest common subsequence: for every length the smallest end position in the
# answer, updated word by word of the reference.
LCS = """, lcs_steps as (
  select row_id, model, 0 as i, []::int[] as ends from tokens
  union all
  select row_id, model, i + 1, case when len(pos) = 0 then ends else
         list_filter(list_transform(range(1, len(ends) + 2), lambda k:
           least(ends[k], list_min(list_filter(pos, lambda j: j > coalesce(ends[k - 1], 0))))),
           lambda v: v is not null)::int[] end
  from (select s.*, list_filter(range(1, len(t.a) + 1), lambda j: t.a[j] = t.r[s.i + 1]) as pos
        from lcs_steps s join tokens t using (row_id, model) where s.i < len(t.r))),
  lcs as (select row_id, model, max(len(ends)) as hits from lcs_steps group by all),
  rouge_l as (select row_id, model, """ + f_score("hits", "len(a)", "len(r)") + """ as rougeL
    from tokens join lcs using (row_id, model))"""

# The same by lines: for every reference line the positions on a longest common
# subsequence with each answer line, traced back from the ends; their union over the
# answer lines; every word counted at most as often as either side holds it.
LINES = f""", answer_lines as (
    select row_id, model, lj, {rouge_tokens('line')} as a from (
      select row_id, model, unnest(string_split(answer, chr(10))) as line,
             generate_subscripts(string_split(answer, chr(10)), 1) as lj from answers)),
  reference_lines as (
    select row_id, model, li, {rouge_tokens('line')} as r from (
      select row_id, model, unnest(string_split(reference, chr(10))) as line,
             generate_subscripts(string_split(reference, chr(10)), 1) as li from answers)),
  line_pairs as (select * from reference_lines join answer_lines using (row_id, model)
                 where list_has_any(r, a)),
  line_steps as (
    select row_id, model, li, lj, r, a, 0 as i, []::int[] as ends from line_pairs
    union all
    select row_id, model, li, lj, r, a, i + 1, case when len(pos) = 0 then ends else
           list_filter(list_transform(range(1, len(ends) + 2), lambda k:
             least(ends[k], list_min(list_filter(pos, lambda j: j > coalesce(ends[k - 1], 0))))),
             lambda v: v is not null)::int[] end
    from (select *, list_filter(range(1, len(a) + 1), lambda j: a[j] = r[i + 1]) as pos
          from line_steps where i < len(r))),
  line_tables as (select row_id, model, li, lj, list(ends order by i) as t from line_steps group by all),
  trace as (
    select row_id, model, li, lj, r, a, t, len(r)::bigint as i, len(a)::bigint as j, null::bigint as hit
    from line_pairs join line_tables using (row_id, model, li, lj)
    union all
    select row_id, model, li, lj, r, a, t,
           case when same or up then i - 1 else i end, case when same then j - 1 when up then j else j - 1 end,
           case when same then i end
    from (select *, r[i] = a[j] as same,
                 len(list_filter(t[i], lambda e: e <= j)) = len(list_filter(t[i + 1], lambda e: e <= j)) as up
          from trace where i > 0 and j > 0)),
  traced as (select row_id, model, word, count(*) as c from (
    select distinct row_id, model, li, hit, r[hit] as word from trace where hit is not null) group by all),
  answer_words as (select row_id, model, word, count(*) as c from (
    select row_id, model, unnest(a) as word from tokens) group by all),
  line_hits as (select row_id, model, sum(least(t.c, w.c))::bigint as hits
                from traced t join answer_words w using (row_id, model, word) group by all),
  rouge_lsum as (select row_id, model, """ + f_score("hits", "len(a)", "len(r)") + """ as rougeLsum
    from tokens left join line_hits using (row_id, model))"""

BLEU_ROWS = """, bleu_rows as (
  select t.row_id, t.model, len(ba) as answer_size, len(br) as reference_size,
         """ + ", ".join(
    f"coalesce(max(hits) filter (n = {n}), 0)::bigint as m{n}" for n in (1, 2, 3, 4)
) + """
  from tokens t left join bleu_shared s using (row_id, model)
  group by t.row_id, t.model, ba, br)"""

JVM_ROWS = f""", plain_rows as (
  select row_id, intent, model, sec, semantic,
         ({normalize('answer')} = {normalize('reference')})::int as exact,
         len({words('answer')}) as answer_words, len({words('reference')}) as reference_words,
         len(list_intersect(list_distinct({words('answer')}), list_distinct({words('reference')})))::double
           / greatest(len({words('reference')}), 1) as shared_words
  from answers)"""

CORPUS = {
    "rouge1": ("rouge", "avg(rouge1)"),
    "rouge2": ("rouge", "avg(rouge2)"),
    "rougeL": ("rouge_l", "avg(rougeL)"),
    "rougeLsum": ("rouge_lsum", "avg(rougeLsum)"),
    "bleu": ("bleu_rows", "case when least("
             + ", ".join(f"sum(m{n})" for n in (1, 2, 3, 4)) + ") > 0 then exp(("
             + " + ".join(f"ln(sum(m{n})::double / sum(greatest(answer_size - {n - 1}, 0)))"
                          for n in (1, 2, 3, 4))
             + ") / 4) * case when sum(answer_size) > sum(reference_size) then 1 else "
               "exp(1 - sum(reference_size)::double / sum(answer_size)) end else 0 end"),
    "bertscore_f1": ("plain_rows", "avg(semantic)"),
    "exact_match": ("plain_rows", "sum(exact)::double / count(*)"),
    "approx_perplexity": ("plain_rows", "1 / greatest(avg(shared_words), 1e-6)"),
    "avg_pred_length_words": ("plain_rows", "sum(answer_words)::double / count(*)"),
    "avg_ref_length_words": ("plain_rows", "sum(reference_words)::double / count(*)"),
    "avg_generation_time_sec": ("plain_rows", "avg(sec)"),
}


def metric_ctes(metrics) -> str:
    """CTEs ending in ``metrics`` (model, metric, value)."""
    sources = {CORPUS[m][0] for m in metrics}
    sql = ANSWERS
    if sources & {"rouge", "rouge_l", "rouge_lsum", "bleu_rows"}:
        sql = ROUGE_SCORES
    if "rouge_l" in sources:
        sql += LCS
    if "rouge_lsum" in sources:
        sql += LINES
    if "bleu_rows" in sources:
        sql += BLEU_N + BLEU_ROWS
    if "plain_rows" in sources:
        sql += JVM_ROWS
    rows = "\n  union all ".join(
        f"select model, {q(m)} as metric, "
        f"printf('%.{config.METRIC_DIGITS[m]}f', ({CORPUS[m][1]})::double)::double as value "
        f"from {CORPUS[m][0]} group by model" for m in metrics
    )
    return sql + f", metrics as ({rows})"


IMPROVEMENT = """, improvement as (
  select metric, max(value) filter (model = 'baseline') as base,
         max(value) filter (model = 'fine_tuned') as tuned,
         case when metric <> 'avg_generation_time_sec' then printf('%.4f',
           (max(value) filter (model = 'fine_tuned') - max(value) filter (model = 'baseline'))::double
         )::double end as delta
  from metrics group by metric)"""


def metrics_sql(*metrics: str) -> str:
    return f"with recursive {metric_ctes(metrics)} select * from metrics"


def compared(metrics, select: str) -> str:
    return f"with recursive {metric_ctes(metrics)}{IMPROVEMENT} {select}"


def fixed_rows(rows, names) -> str:
    """A fixed table with a position column."""
    values = ", ".join("(" + ", ".join([f"{i}::bigint", *(
        q(v) if isinstance(v, str) else str(v).lower() for v in row
    )]) + ")" for i, row in enumerate(rows, 1))
    return f"(values {values}) l(position, {names})"


def shortest(x: str) -> str:
    """A number without zeros beyond the first decimal; N/A if missing."""
    return f"coalesce(regexp_replace(printf('%.4f', {x}), '(\\.\\d+?)0+$', '\\1'), 'N/A')"


LOG = """log as (
  select (event_id + 1) * 10 as step,
         case when event_type <> 'signup' then round_even(0.6::double + value / 100.0::double, 6)::double end as loss,
         case when event_type = 'signup' then round_even(0.6::double + value / 100.0::double, 6)::double end as eval_loss,
         null::double as train_loss
  from events
  union all
  select max((event_id + 1) * 10), null, null, round(avg(value), 6) from events)"""


# --- chat text --------------------------------------------------------------


def block(role: str, content: str) -> str:
    return f"concat('<|im_start|>', {role}, chr(10), {content}, '<|im_end|>', chr(10))"


def lines(text: str) -> str:
    """A literal in which line breaks are spelled out."""
    return "concat(" + ", chr(10), ".join(q(part) for part in text.split("\n")) + ")"


DEFAULT_BLOCK = block("'system'", q(config.DEFAULT_SYSTEM_TEXT))
CALL_OPEN = "concat(chr(10), '<tool_call>', chr(10), '{\"name\": \"lookup\", \"arguments\": {\"'"
CALL_CLOSE = "concat('}}', chr(10), '</tool_call>')"


def tool_answer(content: str) -> str:
    return f"concat(chr(10), '<tool_response>', chr(10), {content}, chr(10), '</tool_response>')"


ORACLES: dict[str, str] = {}

ORACLES["f1_nonblank"] = f"with {NONBLANK} select * from nonblank"
ORACLES["c1_strip"] = f"with {DIRTY} select row_id, {strip('instruction')} as instruction from dirty"
for _name, _vocabulary in {
    "c2_static": {"static": config.STATIC_MARKERS},
    "c3_generated": {"numbers": config.NUMBER_MARKERS},
    "c4_pool": {"pools": config.POOL_MARKERS},
}.items():
    ORACLES[_name] = (
        f"with {DIRTY} select row_id, case when response is not null then "
        f"{replaced('response', 'response', **_vocabulary)} end as response from dirty"
    )
_EMPTY_POOL = {**config.POOL_MARKERS, "Order Number": [config.LEFTOVER_TEXT]}
ORACLES["c4_empty_pool"] = (
    f"with {DIRTY} select row_id, case when response is not null then "
    f"{replaced('response', 'response', pools=_EMPTY_POOL)} end as response from dirty"
)
ORACLES["c8_no_vocabulary"] = (
    f"with {DIRTY} select row_id, {strip(punct(spaces(leftover(strip('response')))))} as response from dirty"
)
for _name, _function in {
    "c5_leftover": leftover, "c6_spaces": spaces, "c7_punct": punct,
}.items():
    ORACLES[_name] = f"with {DIRTY} select row_id, {_function('response')} as response from dirty"
ORACLES["c8_clean"] = (
    f"with {DIRTY} select row_id, case when response is not null then "
    f"{clean('response', 'response')} end as response from dirty"
)
ORACLES["c9_clean_row"] = f"with {CLEANED} select * from cleaned"
ORACLES["c10_normalize"] = f"select doc_id, {normalize('text')} as text from documents"
ORACLES["c11_words"] = (
    f"select doc_id, len({words('text')}) as words, array_to_string({words('text')}, '|') as joined "
    "from documents"
)
ORACLES["c12_messages"] = (
    f"with {PAIRS} select row_id, 3::bigint as n, 'system,user,assistant' as roles, {q(SYSTEM)} as system, "
    f"{strip('instruction')} as user, {strip('response')} as assistant from pairs"
)
ORACLES["c13_chat_columns"] = (
    f"with {PAIRS} select 'messages' as columns, 3::bigint as n, {strip('instruction')} as user from pairs"
)
ORACLES["c14_default"] = (
    f"with {DIRTY} select row_id, nullif(intent, 'intent_3') as intent, '' as category from dirty"
)
ORACLES["c15_truncate"] = (
    "select doc_id, case when length(text) > 300 then concat(substr(text, 1, 300), '...') "
    "else text end as excerpt from documents"
)
ORACLES["c16_preview"] = "select " + ", ".join(
    f"substr({c}::varchar, 1, 120) as {c}" for c in ("doc_id", "text", "lang", "source", "n_chars")
) + " from documents"
ORACLES["c17_json"] = f"""with {PAIRS} select row_id, concat('{{', chr(10),
  '  "row_id" : "', row_id, '",', chr(10), '  "intent" : "', intent, '",', chr(10),
  '  "category" : "', category, '",', chr(10), '  "k" : ', k, chr(10), '}}') as json from pairs"""
ORACLES["c18_format"] = (
    "select event_id, case when event_type = 'error' then 'N/A' else printf('%.4f', value) end as four, "
    "case when event_type = 'error' then 'N/A' else printf('%.2f', value) end as two from events"
)
ORACLES["c19_marker"] = """select event_id,
  case when d > 0.001 then 'up' when d < -0.001 then 'down' when d is not null then 'flat' end as direction,
  case when d is null then 'N/A' when d > 0.001 then concat('+', printf('%.4f', d))
       else printf('%.4f', d) end as change
  from (select event_id, case when event_type <> 'error' then (value - 50) / 5000 end as d from events)"""

ORACLES["c20_chat_text"] = (
    f"with {PAIRS} select row_id, concat({block(q('system'), q(SYSTEM))}, "
    f"{block(q('user'), strip('instruction'))}, {block(q('assistant'), strip('response'))}) as chat from pairs"
)
ORACLES["c21_tools"] = f"""with {PAIRS} select row_id, concat(
  case when k % 3 = 0 then concat('<|im_start|>system', chr(10),
         case when k % 2 = 0 then 'Be brief.' else {q(config.DEFAULT_SYSTEM_TEXT)} end,
         {lines(config.TOOLS_INTRO)}, chr(10), '{{"name": "lookup"}}', chr(10), '{{"name": "other"}}',
         {lines(config.TOOLS_OUTRO)})
       when k % 2 = 0 then {block("'system'", "'Be brief.'")} else {DEFAULT_BLOCK} end,
  {block("'user'", 'instruction')},
  '<|im_start|>assistant', case when k % 5 <> 0 then concat(chr(10), 'One moment.') else '' end,
  {CALL_OPEN}, 'key": ', k, {CALL_CLOSE}), '<|im_end|>', chr(10),
  '<|im_start|>user', {tool_answer("concat('found ', k)")}, {tool_answer('category')}, '<|im_end|>', chr(10),
  {block("'assistant'", 'response')}) as chat from pairs"""
ORACLES["c21_turns"] = f"""with t as (
  select conv_id, turn, case when conv_id % 4 = 0 and role = 'user' and turn > 1 then 'tool' else role end as role,
         text as content, conv_id % 4 = 0 and role = 'assistant' as calls from conversations),
  n as (select *, lag(role) over w as before, lead(role) over w as after from t
        window w as (partition by conv_id order by turn))
  select conv_id, turn, concat(
    case when before is not null then '' when role = 'system' then {block("'system'", 'content')}
         else {DEFAULT_BLOCK} end,
    case when role = 'system' and before is null then ''
         when role = 'tool' then concat(
           case when before = 'tool' then '' else '<|im_start|>user' end, {tool_answer('content')},
           case when after = 'tool' then '' else concat('<|im_end|>', chr(10)) end)
         when calls then concat('<|im_start|>assistant', case when content <> '' then concat(chr(10), content) else '' end,
           {CALL_OPEN}, 'turn": ', turn, {CALL_CLOSE}), '<|im_end|>', chr(10))
         else {block('role', 'content')} end) as chat_text from n"""
ORACLES["c21_turns_tools"] = f"""with t as (
  select conv_id, turn, case when conv_id % 4 = 0 and role = 'user' and turn > 1 then 'tool' else role end as role,
         text as content, conv_id % 4 = 0 and role = 'assistant' as calls from conversations),
  n as (select *, min(turn) over c as first, max(turn) over c as last,
               case when turn > 2 then lag(role) over w end as before,
               case when turn > 1 then lead(role) over w end as after from t
        window w as (partition by conv_id order by turn), c as (partition by conv_id))
  select conv_id, case when turn > 1 then turn + 2 else turn end as turn, concat(
    case when turn > first then ''
         when conv_id % 3 = 0 then concat('<|im_start|>system', chr(10),
           case when role = 'system' then content else {q(config.DEFAULT_SYSTEM_TEXT)} end,
           {lines(config.TOOLS_INTRO)}, chr(10), '{{"name": "lookup"}}', chr(10), '{{"name": "other"}}',
           {lines(config.TOOLS_OUTRO)})
         when role = 'system' then {block("'system'", 'content')} else {DEFAULT_BLOCK} end,
    case when role = 'system' and turn = first then ''
         when role = 'tool' then concat(
           case when before = 'tool' then '' else '<|im_start|>user' end, {tool_answer('content')},
           case when after = 'tool' then '' else concat('<|im_end|>', chr(10)) end)
         when calls then concat('<|im_start|>assistant', case when content <> '' then concat(chr(10), content) else '' end,
           {CALL_OPEN}, 'turn": ', turn, {CALL_CLOSE}), '<|im_end|>', chr(10))
         else {block('role', 'content')} end,
    case when turn = last then concat('<|im_start|>assistant', chr(10)) else '' end) as chat_text from n"""
ORACLES["c22_prompt"] = (
    f"with {PAIRS} select row_id, concat({block(q('system'), 's')}, {block(q('user'), 'instruction')}, "
    f"'<|im_start|>assistant', chr(10)) as prompt from (select *, case when k % 2 = 0 then category "
    f"else {q(SYSTEM)} end as s from pairs)"
)

ORACLES["f2_quality"] = (
    f"with {CLEANED} select row_id, instruction, response from cleaned where ({REASON}) is null"
)
ORACLES["f2_reject_reason"] = (
    f"with {DIRTY} select coalesce({REASON}, 'kept') as reason, count(*) as rows from dirty group by 1"
)
ORACLES["f3_contaminated"] = f"with {DIRTY} select row_id from dirty where contains(response, '{{{{')"
ORACLES["f4_over_budget"] = f"with {PAIRS} select row_id, length(response) > 800 as over_budget from pairs"

ORACLES["s1_shuffle_rank"] = f"with {PAIRS} select row_id, md5('42|' || row_id) as order_hash from pairs"
ORACLES["s2_dedup"] = (
    f"select doc_id, lang, source from documents qualify row_number() over ("
    f"partition by lower({strip('text')}) order by md5('42|' || doc_id), doc_id) = 1"
)
ORACLES["s3_dedup_then_filter"] = f"with {CURATED} select * from curated"
ORACLES["s4_split_exact"] = f"with {SPLIT} select row_id, split from split_rows"
ORACLES["s5_split_hash"] = """select doc_id, bucket,
  case when draw < round(0.1 * 4294967296) then 'test' when draw < round(0.2 * 4294967296) then 'validation'
       else 'train' end as split
  from (select doc_id, draw, draw % 100 as bucket from (
    select doc_id, ('0x' || substr(md5('43|' || doc_id), 1, 8))::bigint as draw from documents))"""
ORACLES["s5_split_hash_small"] = """select event_id,
  case when draw < round(0.002 * 4294967296) then 'test' when draw < round(0.004 * 4294967296) then 'validation'
       else 'train' end as split
  from (select event_id, ('0x' || substr(md5('43|' || event_id), 1, 8))::bigint as draw from events)"""
ORACLES["s6_eval_sample"] = (
    f"with docs as (select * from documents){split_of('docs', 'doc_id')} "
    "select doc_id, split, split_order, text from ordered where split = 'test' and split_pos <= 50"
)
ORACLES["s7_train_subset"] = (
    f"with ev as (select event_id from events){split_of('ev', 'event_id')} select event_id, split from ordered "
    "where (split = 'train' and split_pos <= 5000) or (split = 'validation' and split_pos <= 1000)"
)
ORACLES["s8_first_example"] = (
    f"with {SPLIT} select split, row_id, instruction, response from ordered where split_pos = 1"
)
ORACLES["s9_examples"] = (
    f"with {PREDICTIONS} select row_number() over (order by row_id) as example, row_id, prompt "
    "from predictions order by row_id limit 8"
)

ORACLES["a1_funnel"] = f"""with {CURATED}, c as (
    select (select count(*) from dirty) as loaded, (select count(*) from nonblank) as not_blank,
           (select count(*) from cleaned where contains(response, '{{{{')) as with_markers,
           (select count(*) from deduped) as after_dedup, (select count(*) from curated) as after_quality)
  select *, loaded - not_blank as removed_blank, not_blank - after_dedup as removed_repeats,
         after_dedup - after_quality as removed_quality from c"""
ORACLES["a2_split_sizes"] = (
    f"with {SPLIT} select coalesce(split, 'total') as split, count(*) as rows from split_rows group by rollup(split)"
)


def health_sql(source: str, where: str = "true") -> str:
    return f"""h as (
  select count(*) as rows, count(*) filter (contains(assistant, '{{{{')) as marked_rows,
         100 * count(*) filter (contains(assistant, '{{{{')) // count(*) as marked_percent,
         min(length("user")) as user_min, (sum(length("user")) // count(*))::bigint as user_avg,
         max(length("user")) as user_max,
         min(length(assistant)) as assistant_min,
         (sum(length(assistant)) // count(*))::bigint as assistant_avg,
         max(length(assistant)) as assistant_max,
         count(*) filter (length(assistant) > 800) as over_budget
  from (select {strip('instruction')} as "user", {strip('response')} as assistant from {source} where {where}))"""


ORACLES["a3_contamination_pct"] = (
    f"with {NONBLANK}, {health_sql('nonblank')} select rows, marked_rows, marked_percent from h"
)
_TRAIN_HEALTH = f"with {SPLIT}, " + health_sql("split_rows", "split = 'train'")
ORACLES["a4_lengths"] = (
    _TRAIN_HEALTH + " select user_min, user_avg, user_max, assistant_min, assistant_avg, assistant_max from h"
)
ORACLES["a5_over_budget"] = f"with {PAIRS}, {health_sql('pairs')} select rows, over_budget from h"
ORACLES["r13_health"] = _TRAIN_HEALTH + """ select h.*, 'row_id,instruction,response,intent,category' as columns, p.preview
  from h, (select to_json({row_id: substr(row_id, 1, 120), instruction: substr(instruction, 1, 120),
                           response: substr(response, 1, 120), intent: substr(intent, 1, 120),
                           category: substr(category, 1, 120)})::varchar as preview
           from ordered where split = 'train' and split_pos = 1) p"""
ORACLES["a20_steps"] = """with c as (select least(count(*) - ceil(0.2 * count(*)), 5000)::bigint as train_rows from events)
  select train_rows, 16::bigint as effective_batch, ceil(train_rows / 16.0)::bigint as steps from c"""

ORACLES["a6_exact_match"] = metrics_sql("exact_match")
ORACLES["a7_word_lengths"] = metrics_sql("avg_pred_length_words", "avg_ref_length_words")
ORACLES["a8_overlap_proxy"] = metrics_sql("approx_perplexity")
ORACLES["a9_rouge1"] = metrics_sql("rouge1")
ORACLES["a10_rouge2"] = metrics_sql("rouge2")
ORACLES["a11_rougeL"] = metrics_sql("rougeL")
ORACLES["a12_rougeLsum"] = metrics_sql("rougeLsum")
ORACLES["a13_bleu"] = metrics_sql("bleu")
ORACLES["a14_semantic"] = metrics_sql("bertscore_f1")
ORACLES["a15_latency"] = metrics_sql("avg_generation_time_sec")
ORACLES["row_scores"] = f"""with recursive {ROUGE_SCORES}{LCS}{LINES}{BLEU_N}{BLEU_ROWS}{JVM_ROWS}
  select row_id, model, exact, answer_words, reference_words, round(shared_words, 6) as shared_words,
         round(rouge1, 6) as rouge1, round(rouge2, 6) as rouge2, round(rougeL, 6) as rougeL,
         round(rougeLsum, 6) as rougeLsum,
         m1, m2, m3, m4, answer_size, reference_size
  from plain_rows join rouge using (row_id, model) join rouge_l using (row_id, model)
  join rouge_lsum using (row_id, model)
  join bleu_rows using (row_id, model)"""

INTENTS = ROUGE_SCORES + """, by_intent as (
  select intent, count(*) filter (model = 'baseline') as rows,
         avg(rouge1) filter (model = 'baseline') as b, avg(rouge1) filter (model = 'fine_tuned') as f
  from rouge where intent <> '' group by intent having count(*) filter (model = 'baseline') >= 2)"""
ORACLES["a16_per_intent"] = (
    f"with {INTENTS} select intent, rows, round(b, 6) as base_rouge1, round(f, 6) as ft_rouge1, "
    "round(f - b, 6) as delta from by_intent"
)
ORACLES["f7_intent_guard"] = (
    f"with {INTENTS} select sum(rows)::bigint as rows, count(*) as intents from by_intent"
)
ORACLES["f8_min_group"] = (
    f"with {PREDICTIONS} select concat(intent, '/', split_part(row_id, '-', 1)) as intent, count(*) as rows "
    "from predictions where intent is not null group by 1 having count(*) >= 2"
)

SERIES = f""", series as (
  select 'reference' as series, len({words('reference')}) as words from predictions
  union all select 'baseline', len({words('baseline')}) from predictions
  union all select 'fine_tuned', len({words('fine_tuned')}) from predictions)"""
ORACLES["a17_histogram"] = f"""with {PREDICTIONS}{SERIES},
  u as (select max(words) + 5 as upper from series),
  b as (select series, words * 34 // upper + 1 as bin, count(*) as n from series, u group by all),
  s as (select * from (select distinct series from series), (select unnest(range(1, 35)) as bin), u)
  select series, bin, round((bin - 1) * upper / 34, 6) as low, round(bin * upper / 34, 6) as high,
         coalesce(n, 0) as n from s left join b using (series, bin)"""
ORACLES["a18_series_means"] = (
    f"with {PREDICTIONS}{SERIES} select series, round(avg(words), 6) as mean_words from series group by series"
)
ORACLES["f6_dropna"] = (
    f"with {PREDICTIONS} select 'reference' as series, count(reference) as texts from predictions "
    "union all select 'baseline', count(baseline) from predictions "
    "union all select 'fine_tuned', count(fine_tuned) from predictions where category <> 'CAT_1'"
)

ORACLES["j1_pair_ref"] = f"with {ANSWERS} select row_id, model, answer, reference from answers"
ORACLES["j2_side_by_side"] = (
    f"with {PREDICTIONS} select row_id, prompt, reference, baseline, baseline_sec, fine_tuned, fine_tuned_sec "
    "from predictions"
)

ORACLES["j2_repeated_runs"] = f"""with {PREDICTIONS}, r as (
    select row_id, 'b' as m, baseline as answer, baseline_sec as sec from predictions
    union all select row_id, 'f', fine_tuned, fine_tuned_sec from predictions),
  every as (select * from r union all select row_id, m, substr(answer, 1, 10), sec + 100 from r
            where ('0x' || substr(md5(row_id), 1, 8))::bigint % 3 = 0),
  best as (select *, row_number() over (partition by row_id, m order by answer desc, sec desc) as n
           from every where answer is not null)
  select p.row_id, p.reference, b.answer as baseline, b.sec as baseline_sec, f.answer as fine_tuned, f.sec as fine_tuned_sec
  from predictions p join best b on b.row_id = p.row_id and b.m = 'b' and b.n = 1
  join best f on f.row_id = p.row_id and f.m = 'f' and f.n = 1"""

SQL_METRICS = tuple(CORPUS)
ORACLES["r1_metric_set"] = metrics_sql(*SQL_METRICS)
ORACLES["r2_improvement"] = compared(SQL_METRICS, "select * from improvement")
ORACLES["r3_result"] = compared(
    SQL_METRICS,
    "select (select count(*) from predictions) as eval_samples, " + ", ".join(
        f"max({column}) filter (metric = {q(m)}) as {part}_{m}"
        for part, column in (("base_model", "base"), ("fine_tuned", "tuned"), ("improvement", "delta"))
        for m in SQL_METRICS if part != "improvement" or m != "avg_generation_time_sec"
    ) + " from improvement",
)
ORACLES["r4_summary"] = compared(tuple(config.SUMMARY_LABELS), f"""
  select position, label, {shortest('base')} as base, {shortest('tuned')} as tuned,
         case when delta is null then 'N/A' else
           concat(case when delta >= 0 then '+' else '' end, {shortest('delta')}) end as delta
  from {fixed_rows(config.SUMMARY_LABELS.items(), 'metric, label')} left join improvement using (metric)""")
_VERDICT = {m: f"coalesce(max(delta) filter (metric = '{m}'), 0)" for m in ("rouge1", "bleu")}
ORACLES["r5_verdict"] = compared(("rouge1", "bleu"), f"""
  select {_VERDICT['rouge1']} as rouge1_delta, {_VERDICT['bleu']} as bleu_delta,
         case when {_VERDICT['rouge1']} > 0.02 and {_VERDICT['bleu']} > 0 then 'success'
              when {_VERDICT['rouge1']} > 0 then 'marginal' else 'none' end as verdict from improvement""")


def _shown(x: str) -> str:
    return (f"case when {x} is null and not shows_change then '—' when {x} is null then 'N/A' when digits = 4 then printf('%.4f', {x}) "
            f"when digits = 2 then printf('%.2f', {x}) else {shortest(x)} end")


ORACLES["r6_executive"] = compared(tuple(config.EXECUTIVE_ROWS), f"""
  select position, label, {_shown('base')} as base, {_shown('tuned')} as tuned,
         case when not shows_change or delta is null then null when delta > 0.001 then 'up'
              when delta < -0.001 then 'down' else 'flat' end as direction,
         case when not shows_change then '—' when delta is null then 'N/A'
              when delta > 0.001 then concat('+', printf('%.4f', delta))
              else printf('%.4f', delta) end as change
  from {fixed_rows([(k, *v) for k, v in config.EXECUTIVE_ROWS.items()], 'metric, label, digits, shows_change')}
  left join improvement using (metric)""")
ORACLES["r7_bars"] = compared(config.COMPARISON_KEYS, f"""
  select position, metric, model, coalesce(case model when 'baseline' then base else tuned end, 0) as value
  from {fixed_rows([(k,) for k in config.COMPARISON_KEYS], 'metric')} left join improvement using (metric),
       (values ('baseline'), ('fine_tuned')) m(model)""")
ORACLES["r8_rouge_series"] = compared(config.ROUGE_KEYS, f"""
  select position, metric, model, coalesce(case model when 'baseline' then base else tuned end, 0) as value
  from {fixed_rows([(k,) for k in config.ROUGE_KEYS], 'metric')} left join improvement using (metric),
       (values ('baseline'), ('fine_tuned')) m(model)""")
ORACLES["r9_heat_scale"] = compared(config.IMPROVEMENT_KEYS, f""", d as (
  select position, metric, coalesce(delta, 0) as delta
  from {fixed_rows([(k,) for k in config.IMPROVEMENT_KEYS], 'metric')} left join improvement using (metric))
  select *, greatest((select max(abs(delta)) from d), 0.01::double) as scale from d""")
ORACLES["r11_examples"] = f"""with {PREDICTIONS}
  select row_number() over (order by row_id) as example, row_id, coalesce(intent, '—') as intent, category, prompt,
         """ + ", ".join(
    f"case when length({c}) > 300 then concat(substr({c}, 1, 300), '...') else {c} end as {c}"
    for c in ("reference", "baseline", "fine_tuned")
) + " from predictions order by row_id limit 8"
_GUIDE = fixed_rows(
    [(k, *v) for k, v in config.METRIC_GUIDE.items()],
    'metric, label, meaning, "range", threshold, higher',
)
ORACLES["r12_thresholds"] = compared(tuple(config.METRIC_GUIDE), f"""
  select position, label, meaning, "range", threshold::double as threshold,
         case when higher then base > threshold else base < threshold end as base_meets,
         case when higher then tuned > threshold else tuned < threshold end as tuned_meets
  from {_GUIDE} left join improvement using (metric)""")

ORACLES["f5_log_kind"] = f"""with {LOG} select *, case when loss is not null then 'train'
  when eval_loss is not null then 'eval' else 'summary' end as kind from log"""
ORACLES["a19_train_stats"] = f"""with {LOG} select
  (select loss from log where loss is not null order by step limit 1) as first_loss,
  (select loss from log where loss is not null order by step desc limit 1) as last_loss,
  min(eval_loss) as best_eval_loss, max(step) as steps from log"""
ORACLES["r10_loss_curve"] = f"""with {LOG} select 'train' as series, step, loss from log where loss is not null
  union all select 'validation', step, eval_loss from log where eval_loss is not null"""

ORACLES["io3_raw_roundtrip"] = (
    f"with {SPLIT} select row_id, instruction, response, intent, category from split_rows where split = 'train'"
)
ORACLES["io2_chat_roundtrip"] = (
    f'with {SPLIT} select split, row_id, {strip("instruction")} as "user", '
    f"{strip('response')} as assistant from split_rows"
)
ORACLES["io5_csv_roundtrip"] = f"with {PREDICTIONS} select " + ", ".join(
    f"nullif({c}, '') as {c}" for c in config.PREDICTION_SCHEMA.fieldNames()
) + " from predictions"
ORACLES["io7_metrics_roundtrip"] = f"""with recursive {metric_ctes(
    ("rouge1", "bleu", "exact_match", "avg_pred_length_words"))}
  select m.model, k.metric, value from (values ('baseline'), ('fine_tuned')) m(model)
  cross join (values {', '.join(f'({q(k)})' for k in config.METRIC_DIGITS)}) k(metric)
  left join metrics using (model, metric)"""
ORACLES["io8_log_read"] = f"with {LOG} select * from log"
ORACLES["io9_state_read"] = f"with {LOG} select * from log"

ORACLES["io6_report_from_csv"] = f"""with {PREDICTIONS}
  select least(count(*), {config.EXAMPLE_ROWS}) as examples, least(count(*), {config.EXAMPLE_ROWS}) as last,
         (count(reference) + count(nullif(baseline, '')) + count(nullif(fine_tuned, '')))::bigint as texts
  from predictions"""
ORACLES["plan_evaluate"] = metrics_sql(*SQL_METRICS)
ORACLES["io1_rows_without_key"] = (
    f"with {DIRTY} select nullif(instruction, '') as instruction, nullif(response, '') as response, intent, category, "
    "64::bigint as key_length from dirty"
)


# --- semantic score by greedy token alignment ----------------------------------

def _tokens(x: str) -> str:
    return f"list_filter(string_split_regex(lower(coalesce({x}, '')), {q(TOKEN_SPLIT)}), lambda w: w <> '')"


TOKEN_SPLIT = r"[\x20\x09-\x0D]+"

SEMANTIC_ROWS = ANSWERS + f""", toks as (
  select row_id, model, side, tok, count(*)::double as n from (
    select row_id, model, 'a' as side, unnest({_tokens('answer')}) as tok from answers
    union all
    select row_id, model, 'r' as side, unnest({_tokens('reference')}) as tok from answers)
  group by all),
corpus_m as (select count(*)::double as m from predictions),
corpus_df as (
  select tok, count(*) as df from (select unnest(list_distinct({_tokens('reference')})) as tok from predictions)
  group by tok),
vec as (select vec_id, embedding::double[] as v from embeddings),
usable as (
  select vec_id, min(list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))))
         as u
  from vec
  where v is not null and len(v) > 0
    and list_bool_and(list_transform(v, lambda x: coalesce(isfinite(x), false)))
    and list_sum(list_transform(v, lambda y: y * y)) > 0
  group by vec_id),
buckets as (select max(vec_id) + 1 as nb from embeddings),
token_table as (
  select t.tok, ln((corpus_m.m + 1) / (coalesce(corpus_df.df, 0) + 1)) as w, usable.u
  from (select distinct tok from toks) t cross join corpus_m
  left join corpus_df using (tok)
  left join usable
    on usable.vec_id = ('0x' || substr(md5(t.tok), 1, 8))::ubigint % (select nb from buckets)),
best as (
  select x.row_id, x.model, x.side, x.tok, x.n * tx.w as wt,
         max(coalesce(list_dot_product(tx.u, ty.u), 0)) as best
  from toks x join token_table tx on tx.tok = x.tok
  join toks y on y.row_id = x.row_id and y.model = x.model and y.side <> x.side
  join token_table ty on ty.tok = y.tok
  group by x.row_id, x.model, x.side, x.tok, x.n, tx.w),
sides as (
  select row_id, model,
         coalesce(sum(wt * best) filter (where side = 'a') / nullif(sum(wt) filter (where side = 'a'), 0), 0) as p,
         coalesce(sum(wt * best) filter (where side = 'r') / nullif(sum(wt) filter (where side = 'r'), 0), 0) as r
  from best group by row_id, model),
semantic_rows as (
  select a.row_id, a.model, coalesce(s.p, 0) as p, coalesce(s.r, 0) as r
  from answers a left join sides s using (row_id, model))"""

ORACLES["a14_semantic_rows"] = "with " + SEMANTIC_ROWS + f"""
select row_id, model, round(p, 6) as precision, round(r, 6) as recall,
       round(case when p + r <> 0 then 2 * p * r / (p + r) else 0 end, 6) as f1
from semantic_rows"""

ORACLES["a14_semantic_score"] = "with " + SEMANTIC_ROWS + f"""
select model, round(avg(round(case when p + r <> 0 then 2 * p * r / (p + r) else 0 end, 6)), 6) as semantic_f1,
       count(*) as answers
from semantic_rows group by model"""


# --- resampled means ---------------------------------------------------------

def _poisson(u: str) -> str:
    from turnmill.operators.bootstrap import BOUNDS
    cases = " ".join(f"when {u} < {b!r}::double then {k}" for k, b in enumerate(BOUNDS))
    return f"case {cases} else {len(BOUNDS)} end"


_U = "('0x' || substr(md5(row_id || ':' || b::varchar), 1, 8))::ubigint::double / 4294967296.0"

ORACLES["a9_rouge_intervals"] = f"""with recursive {ROUGE_SCORES}{LCS}{LINES}, scores as (
  select row_id, model, rouge1, rouge2, rougeL, rougeLsum
  from rouge join rouge_l using (row_id, model) join rouge_lsum using (row_id, model)),
long as (
  select row_id, model, unnest(['rouge1', 'rouge2', 'rougeL', 'rougeLsum']) as metric,
         unnest([rouge1, rouge2, rougeL, rougeLsum]) as x
  from scores),
drawn as (
  select model, metric, x, b, {_poisson('u')} as w
  from (select l.*, r.range as b, {_U.replace('b::varchar', 'r.range::varchar')} as u from long l cross join range(1000) r)),
means as (
  select model, metric, b, sum(w * x) / sum(w) as m from drawn where w > 0 and x is not null group by all),
spread as (
  select model, metric, quantile_cont(m, [0.025, 0.5, 0.975]) as q from means where m is not null group by all),
plain as (select model, metric, count(*) as n, avg(x) as mean from long where x is not null group by all)
select model, metric, n, round(mean, 6) as mean, round(q[1], 6) as low, round(q[2], 6) as mid, round(q[3], 6) as high
from plain join spread using (model, metric)"""


# --- records with both losses --------------------------------------------------

ORACLES["r10_loss_curve_both"] = f"""with {LOG}, both_log as (
  select step, loss,
         case when loss is not null and step % 50 = 10 then loss else eval_loss end as eval_loss
  from log)
select * from (
  select 'train' as series, step, loss from both_log where loss is not null
  union all
  select 'validation', step, eval_loss from both_log where eval_loss is not null)
where exists (select 1 from both_log where loss is not null)"""
