"""Template expansion as rounds of Spark joins.

Each round takes the innermost calls ``{{name|args}}`` out of all texts that still have calls, evaluates parser functions as
expressions, joins the other names to the store, puts the arguments into the bodies, and the results back into the
texts. A round resolves one level of nesting everywhere at once; the rounds end when no text has a call.

A call that a body brings in carries the names of the templates it came through. A name that repeats as a pattern at the
end of these gives the notice of a loop, and one behind MAX_DEPTH names the error of a recursion that is too deep, so
the rounds always end. Arguments are evaluated before the function (innermost first), but for the branches of conditions:
these are held back until one is taken, and the others never become calls. A budget of different calls and of characters ends
the expansion of a text that grows without end, with a note. A name that is not found gives [[:Template:name]].
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.library import nowiki
from ..functions.parserfns import FUNCTIONS, NAMESPACES, UNIMPLEMENTED, dispatch, expr
from ..functions.texts import quoted, replace_all, strip
from ..plans.folders import cut, discard, shuffled
from .braces import LAZY, RELEASED, bound, settling
from .cleanup import visible_text

#: Innermost calls: parameters that have no value, and braces that stand alone, are text inside of them.
CALL = r"(?<!\{)\{\{(?!\{)[^{}]*+(?:(?:\{\{\{[^{}]*\}\}\}|(?<!\{)\{(?!\{)|(?<!\})\}(?!\}))[^{}]*+)*+\}\}"
#: What opens calls: two braces, and both halves of four.
OPENS = r"(?<!\{)\{\{(?=\{\{(?!\{))|(?<=(?<!\{)\{\{)\{\{(?!\{)|(?<!\{)\{\{(?!\{)"
#: Functions whose value comes from the store; those of the first group from the page that the first argument names.
OF_PAGE = ("#ifexist", "PAGESIZE", "#lst", "#section", "#Abschnitt", "#trecho", "#קטע", "int")
OF_STORE = ("NUMBEROFPAGES", "NUMBEROFARTICLES")
#: These look into tables of statements and of language names.
OF_TABLES = ("#property", "#statements", "#language")
SUMS = ("#expr", "#ifexpr")
# Nesting from which on a template isn't expanded, and the texts of faults, which pages test for.
MAX_DEPTH = 100
TOO_DEEP = '<strong class="error">too deep recursion while expanding template '
LOOP = '<strong class="error">Template loop detected: [[:Template:'
NO_PAGE = '<strong class="error">Page not found for PAGESIZE</strong>'
NO_ARGUMENT = '<strong class="error">No arguments given to #pagesize</strong>'
#: Control characters that text can't hold: a call's history, its end, its parts, what stands for the braces of calls that stay, and for nowiki elements that hold nothing.
_FROM, _TO, _STEP, _SHUT, _NOTHING, _EMPTY = "\x11", "\x12", "\x13", "\x0e\x0f", "\x10", "\x14"


def _arguments(inside: str) -> str:
    """SQL: the parts between bars; bars within [[ ]] don't count."""
    links = f"regexp_extract_all({inside}, {quoted(r'\[\[[^\[\]]*\]\]')}, 0)"
    kept = f"array_join(zip_with(split({inside}, {quoted(r'\[\[[^\[\]]*\]\]')}, -1), {links}, (a, l) -> concat(a, coalesce(replace(l, '|', '\\u0006'), ''))), '')"
    return f"transform(split({kept}, '[|]', -1), x -> replace(x, '\\u0006', '|'))"


def parsed_call(call: str, aliases: dict[str, str] | None = None) -> str:
    """SQL for struct(name, args, past): name stripped; a parser function's first argument follows a colon; past: names of templates it came through."""
    inside = f"substr({call}, 3, length({call}) - 4)"
    past = f"IF(startswith({inside}, {quoted(_FROM)}), filter(split(substr(substring_index({inside}, {quoted(_TO)}, 1), 2), {quoted(_STEP)}), n -> n <> ''), cast(array() as array<string>))"
    bare = f"IF(startswith({inside}, {quoted(_FROM)}), substr({inside}, instr({inside}, {quoted(_TO)}) + 1), {inside})"
    head = "p[0]"
    given = strip(f"substring_index({head}, {quoted(chr(58))}, 1)")
    renamed = " ".join(f"WHEN {quoted(a)} THEN {quoted(b)}" for a, b in (aliases or {}).items())
    function = f"(CASE {given} {renamed} ELSE {given} END)" if renamed else given
    names = ", ".join(quoted(n) for n in [*FUNCTIONS, *SUMS, *UNIMPLEMENTED, *OF_PAGE, *OF_TABLES])
    # names of functions are told in any case, unless they are written as one is
    function = f"(CASE WHEN {function} IN ({names}) THEN {function} WHEN lower({function}) IN ({names}) THEN lower({function}) ELSE {function} END)"
    split = f"IF({function} IN ({names}) AND instr({head}, ':') > 0, struct({function} AS name, concat(array(substr({head}, instr({head}, ':') + 1)), slice(p, 2, size(p))) AS args, {past} AS past), struct({strip(head)} AS name, slice(p, 2, size(p)) AS args, {past} AS past))"
    return f"transform(array({_arguments(bare)}), p -> {split})[0]"


def on_new_line(text: str) -> str:
    """SQL: a result that begins a list or table gets a line of its own."""
    return f"IF({text} RLIKE {quoted(r'^(?:[*#;:]|\{\||\x15\x17)')}, concat('\\n', {text}), {text})"


def _of_page() -> str:
    """SQL for the functions of OF_PAGE over name, args and the joined __title and __body (null if there is no such page)."""
    arg = lambda i: strip(f"coalesce(get(args, {i}), '')")
    size = "cast(octet_length(coalesce(__body, '')) as string)"
    commas = f"regexp_replace({size}, '(?<=[0-9])(?=(?:[0-9]{{3}})+$)', ',')"
    missing = f"IF(size(args) = 0, {quoted(NO_ARGUMENT)}, {quoted(NO_PAGE)})"
    quote = "[\"\\x27]?"
    begin, middle, end = quoted(rf"(?is)<section\s+begin\s*=\s*{quote}\Q"), quoted(rf"\E{quote}\s*/>(.*?)<section\s+end\s*=\s*{quote}\Q"), quoted(rf"\E{quote}\s*/>")
    mark = f"concat({begin}, {arg(1)}, {middle}, {arg(1)}, {end})"
    message = "coalesce(__body, concat('⧼', regexp_replace(__want, '^MediaWiki:', ''), '⧽'))"
    filled = f"aggregate(sequence(1, greatest(1, size(args) - 1)), {message}, (m, i) -> replace(m, concat('$', i), coalesce(get(args, i), concat('$', i))))"
    return (
        f"CASE name WHEN '#ifexist' THEN IF(__title IS NOT NULL, {arg(1)}, {arg(2)}) "
        f"WHEN 'PAGESIZE' THEN IF(__title IS NULL, {missing}, IF({arg(1)} = 'R', {commas}, {size})) WHEN 'int' THEN {filled} "
        f"ELSE array_join(regexp_extract_all(coalesce(__body, ''), {mark}, 1), '') END"
    )


def prepared(text: str) -> str:
    """SQL: what nowiki elements hold as entities, so that it takes no part; comments go, each with one line end before it."""
    pattern = quoted(r"(?is)<nowiki\s*>(.*?)</nowiki\s*>")
    held = f"regexp_extract_all({text}, {pattern}, 1)"
    made = f"IF(c = '', {quoted(_EMPTY)}, {nowiki('c')})"
    plain = f"array_join(zip_with(split({text}, {pattern}, -1), {held}, (a, c) -> concat(a, IF(c IS NULL, '', {made}))), '')"
    marked = replace_all(f"IF(instr(lower({text}), '<nowiki') > 0, {plain}, {text})", r"(?i)<nowiki\s*/>", _NOTHING)
    return replace_all(marked, r"(?s)\n?<!--.*?-->", "")


def _repeats(names: str) -> str:
    """SQL: whether ``names`` ends in a pattern that stands there twice or more."""
    return f"exists(sequence(1, greatest(1, cast(size({names}) / 2 as int))), k -> size({names}) >= 2 * k AND slice({names}, -k, k) = slice({names}, -2 * k, k))"


def _shut(text: str) -> str:
    """SQL: ``text`` closed to further rounds."""
    return f"translate({text}, '{{}}', {quoted(_SHUT)})"


def _tagged(text: str, chain: str) -> str:
    """SQL: the calls of ``text`` get the names they came through."""
    return f"array_join(split({text}, {quoted(OPENS)}, -1), concat('{{{{', {quoted(_FROM)}, array_join({chain}, {quoted(_STEP)}), {quoted(_TO)}))"


def expand(
    texts: DataFrame,
    store: DataFrame,
    key: str,
    text_col: str,
    title_col: str,
    max_depth: int = MAX_DEPTH,
    statements: DataFrame | None = None,
    languages: DataFrame | None = None,
    only: Iterable[str] | None = None,
    never: Iterable[str] = (),
    given: str | None = None,
    after: str | None = None,
    aliases: dict[str, str] | None = None,
    variants: bool = False,
    notes: bool = False,
    max_calls: int | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """(key, expanded): ``texts`` (key unique, text_col, title_col) with all calls expanded from ``store`` (title, body; redirects resolved).

    statements: (item, property, value) for #property and #statements; an item '' stands for that of the page itself and
    misses give ''. languages: (code, name). only, never: names of templates that alone are, or never are, expanded;
    others stay as they are written. given: SQL over name and args whose value, if not null, takes a template's place;
    after: SQL over name, args and value that changes a result where it isn't null. aliases: other names of parser
    functions. variants: marks of language variants go. notes: also an array of struct(kind, name) of what went wrong: loop,
    depth, missing, budget. max_calls, max_chars: a text that has had more calls (equal ones of a round once), or is longer after a round, is left as it then is, its
    calls unexpanded; none is no limit. A null text stays null. Results begin on a new line where they begin a list or table.
    """
    spark = texts.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        raise ValueError("expansion writes its rounds to spark.checkpoint.dir")
    bodies = cut(store.selectExpr("title AS __title", f"{prepared(on_list_line('coalesce(body, ' + quoted('') + ')'))} AS __body"))
    spaces = [n for _, n, _ in NAMESPACES if n]
    article = ~F.substring_index("title", ":", 1).isin(*spaces) | ~F.contains("title", F.lit(":"))
    pages, articles = store.agg(F.count("*"), F.count(F.when(article, 1))).first()
    none = "cast(array() as array<struct<kind:string,name:string>>)"
    state = texts.select(key, F.col(text_col).alias("__text"), F.col(title_col).alias("__page"))
    state = state.withColumn("expanded", F.expr(prepared("__text"))).withColumn("__notes", F.expr(none)).drop("__text")
    # a page has no arguments: parameters in its own text get their defaults
    state = state.withColumn("expanded", bound(F.col("expanded"), F.array().cast("array<string>")))
    # both halves of four braces open a call
    state = state.withColumn("expanded", F.expr(f"IF(instr(expanded, '{{{{{{{{') > 0, {_tagged('expanded', 'cast(array() as array<string>)')}, expanded)"))
    known = [*FUNCTIONS, *UNIMPLEMENTED]
    own = [*known, *OF_PAGE, *OF_STORE, *OF_TABLES, *SUMS]
    shut = _shut("call")
    names_of = aliases or {}
    settle = settling(LAZY | {a: LAZY[b] for a, b in names_of.items() if b in LAZY}, CALL)
    state = state.withColumn("__calls", F.lit(0).cast("long"))
    over = f"__calls > {max_calls if max_calls is not None else 2**62} OR length(expanded) > {max_chars if max_chars is not None else 2**62}"
    done, parts = [], None
    while True:
        state = state.withColumn("expanded", settle("expanded"))
        if max_calls is not None or max_chars is not None:
            ends = F.expr(f"expanded RLIKE {quoted(CALL)} AND ({over})")
            state = state.withColumn("__notes", F.when(ends, F.expr("concat(__notes, array(struct('budget' AS kind, __page AS name)))")).otherwise(F.col("__notes")))
            state = state.withColumn("expanded", F.when(ends, F.expr(f"translate(expanded, '{{}}', {quoted(_SHUT)})")).otherwise(F.col("expanded")))
        has = F.col("expanded").rlike(CALL)
        # only texts with calls go on
        state = cut(state.withColumn("__open", F.coalesce(has, F.lit(False))))
        if parts is not None:
            discard(parts)
        done.append(state.filter("NOT __open").drop("__open"))
        state = state.filter("__open").drop("__open")
        calls = state.select(key, "__page", F.explode(F.expr(f"array_distinct(regexp_extract_all(expanded, {quoted(CALL)}, 0))")).alias("call"))
        parts = cut(calls.withColumn("p", F.expr(parsed_call("call", aliases))).select(key, "__page", "call", "p.name", "p.args", "p.past"))
        # at most the functions there are, and null for all other names
        names = {r[0] for r in parts.select(F.when(F.col("name").isin(*own), F.col("name"))).distinct().collect()}
        if not names:
            discard(parts, bodies)
            break
        values = []

        def add(rows: DataFrame, note: str = none) -> None:
            values.append(rows.selectExpr(key, "call", "value", f"{note} AS note"))  # noqa: B023

        # unimplemented functions give the call itself, closed to further rounds
        if names & set(known):
            add(parts.filter(F.col("name").isin(*known)).withColumn("value", F.expr(f"coalesce({dispatch('name', 'args', '__page', names)}, {shut})")))
        if names & set(SUMS):
            sums = parts.filter(F.col("name").isin(*SUMS)).withColumn("v", expr(F.coalesce(F.get("args", F.lit(0)), F.lit(""))))
            branch = lambda i: strip(f"coalesce(get(args, {i}), '')")
            add(sums.withColumn("value", F.expr(f"IF(name = '#expr', v, IF(v RLIKE '^-?[0-9]+$' AND v NOT RLIKE '^-?0+$', {branch(1)}, {branch(2)}))")))
        if names & set(OF_STORE):
            add(parts.filter(F.col("name").isin(*OF_STORE)).withColumn("value", F.when(F.col("name") == "NUMBEROFPAGES", F.lit(str(pages))).otherwise(F.lit(str(articles)))))
        first = strip("coalesce(get(args, 0), '')")
        if names & {"#property", "#statements"}:
            asked = parts.filter(F.col("name").isin("#property", "#statements")).withColumn("__p", F.expr(first))
            asked = asked.withColumn("__i", F.expr(f"IF(startswith(coalesce(get(args, 1), ''), 'from='), {strip('substr(args[1], 6)')}, '')"))
            if statements is None:
                add(asked.withColumn("value", F.lit("")))
            else:
                right = statements.groupBy(F.col("item").alias("__item"), F.col("property").alias("__prop")).agg(F.array_join(F.array_sort(F.collect_set("value")), ", ").alias("__v"))
                add(asked.join(right, (F.col("__i") == F.col("__item")) & (F.col("__p") == F.col("__prop")), "left").withColumn("value", F.coalesce("__v", F.lit(""))))
        if "#language" in names:
            asked = parts.filter("name = '#language'").withColumn("__c", F.expr(first))
            if languages is None:
                add(asked.withColumn("value", F.col("__c")))
            else:
                right = languages.select(F.col("code").alias("__code"), F.col("name").alias("__language"))
                add(asked.join(right, F.col("__c") == F.col("__code"), "left").withColumn("value", F.coalesce("__language", F.lit(""))))
        if names & set(OF_PAGE):
            paged = parts.filter(F.col("name").isin(*OF_PAGE))
            want = f"IF(name = 'int', concat('MediaWiki:', upper(substr({first}, 1, 1)), substr({first}, 2)), regexp_replace(replace({first}, '_', ' '), '^(?:Main)?:', ''))"
            paged = paged.withColumn("__want", F.expr(want)).withColumn("__chain", F.expr("concat(past, array(__want))")).join(bodies, F.col("__want") == F.col("__title"), "left")
            looped = f"concat({quoted(LOOP)}, name, ']]</strong>')"
            add(paged.withColumn("value", F.expr(f"IF({_repeats('__chain')}, {looped}, {_tagged(_of_page(), '__chain')})")))
        if None in names:
            other = parts.filter(F.col("name").isNull() | ~F.col("name").isin(*own))
            local = "regexp_replace(regexp_replace(replace(name, '_', ' '), '^(?i)(?:safe)?subst:\\\\s*', ''), '^(?i)template:', '')"
            other = other.withColumn("__local", F.expr(local))
            other = other.withColumn("__want", F.expr("IF(startswith(__local, ':'), substr(__local, 2), concat('Template:', upper(substr(__local, 1, 1)), substr(__local, 2)))"))
            other = other.withColumn("__chain", F.expr("concat(past, array(__want))"))
            other = other.withColumn("__loops", F.expr(_repeats("__chain"))).withColumn("__deep", F.size("past") >= max_depth)
            kept = F.lit(False) if only is None else ~F.col("__local").isin(*only)
            other = other.withColumn("__kept", kept | F.col("__local").isin(*never) if list(never) else kept)
            other = other.withColumn("__given", F.expr(given or "cast(NULL as string)").cast("string"))
            found = other.join(bodies, F.col("__want") == F.col("__title"), "left")
            found = found.withColumn("__bound", bound(F.col("__body"), F.col("args")))
            inner = _tagged("__bound", "__chain")
            value = (
                f"CASE WHEN __kept THEN {shut} WHEN __deep THEN concat({quoted(TOO_DEEP)}, {shut}, '</strong>') WHEN __loops THEN concat({quoted(LOOP)}, name, ']]</strong>') "
                f"WHEN __given IS NOT NULL THEN {_shut('__given')} WHEN __title IS NULL THEN concat('[[:', IF(startswith(__want, 'Template:'), concat('Template:', name), __want), ']]') ELSE {inner} END"
            )
            found = found.withColumn("value", F.expr(value))
            if after is not None:
                changed = F.expr(after).cast("string")
                found = found.withColumn("value", F.when(F.col("__kept"), F.col("value")).otherwise(F.coalesce(F.translate(changed, "{}", _SHUT), "value")))
            note = "CASE WHEN __kept THEN NULL WHEN __deep THEN 'depth' WHEN __loops THEN 'loop' WHEN __given IS NULL AND __title IS NULL THEN 'missing' END"
            add(found, f"transform(filter(array({note}), k -> k IS NOT NULL), k -> struct(k AS kind, name AS name))")
        every = values[0]
        for more in values[1:]:
            every = every.unionByName(more)
        every = every.withColumn("value", F.expr(on_new_line("value")))
        maps = every.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("call", "value"))).alias("__v"), F.flatten(F.collect_list("note")).alias("__n")).withColumnRenamed(key, "__key")
        joined = state.join(shuffled(maps), state[key] == maps["__key"])
        pieces = f"zip_with(split(expanded, {quoted(CALL)}, -1), regexp_extract_all(expanded, {quoted(CALL)}, 0), (a, c) -> concat(a, IF(c IS NULL, '', __v[c])))"
        state = joined.select(key, F.expr(f"array_join({pieces}, '')").alias("expanded"), "__page", F.concat("__notes", "__n").alias("__notes"), F.expr("__calls + cardinality(__v)").alias("__calls"))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    # what a call that stays was closed with, and its history, turn back
    past = replace_all("expanded", f"{_FROM}[^{_TO}]*{_TO}", "")
    marks, ways = "".join(RELEASED), "".join(RELEASED.values())
    text = f"replace(translate({past}, {quoted(_SHUT + marks)}, {quoted('{}' + ways)}), {quoted(_NOTHING)}, '<nowiki />')"
    text = f"replace({text}, {quoted(_EMPTY)}, '<nowiki/>')"
    if variants:
        text = f"replace(replace({text}, '-{{', ''), '}}-', '')"
    return result.select(key, F.expr(text).alias("expanded"), *([F.col("__notes").alias("notes")] if notes else []))


def on_list_line(text: str) -> str:
    """SQL: a body that begins a list begins on a line of its own."""
    return f"IF(left({text}, 1) IN ('#', '*', ';', ':'), concat('\\n', {text}), {text})"


def expanded_text(texts: DataFrame, store: DataFrame, key: str, text_col: str, title_col: str, **options) -> DataFrame:
    """(key, expanded, text, parse_error): expansion, its visible text, and what went wrong in the order of rounds; a null expansion falls back to the text."""
    made = expand(texts, store, key, text_col, title_col, notes=True, **options).withColumnRenamed(key, "__key")
    both = texts.select(key, F.col(text_col).alias("__given")).join(shuffled(made), F.col(key) == F.col("__key"))
    both = both.select(key, F.coalesce("expanded", "__given").alias("expanded"), "notes")
    # a page that is missing is a notice, not an error
    bad = "array_distinct(transform(filter(notes, n -> n.kind <> 'missing'), n -> concat(n.kind, ': ', n.name)))"
    return visible_text(both, "expanded", "text").select(key, "expanded", "text", F.expr(f"IF(size({bad}) > 0, concat('WTP ', array_join({bad}, '; ')), NULL)").alias("parse_error"))
