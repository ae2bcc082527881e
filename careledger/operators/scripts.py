"""Script-corpus jobs (T1-T5) over a table ``(script_id string, text string)``.

The runner's per-string routines become column expressions: every script is
one row, its statements an array built by ``split``; classification, the
running query count and the setup carried to later queries are folds over
that array (``aggregate`` / ``transform``), so a whole corpus is processed
by narrow, shuffle-free stages whose cost grows with the text, and no
script ever meets another one.

Regex dialect: the patterns are the runner's JavaScript ones.  Java's
``\\s``, ``.`` and ``\\b`` differ from JavaScript's on non-ASCII input, so
the JavaScript classes are spelled out below and word boundaries are
explicit ASCII look-arounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# JavaScript character classes.
JS_WS = (r"[\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
         r"\x{202F}\x{205F}\x{3000}\x{FEFF}]")
JS_NOT_LINE_END = r"[^\n\r\x{2028}\x{2029}]"
WB_BEFORE = r"(?<![A-Za-z0-9_])"
WB_AFTER = r"(?![A-Za-z0-9_])"


def _words(*alternatives: str) -> str:
    return WB_BEFORE + "(?:" + "|".join(alternatives) + ")" + WB_AFTER


# The runner's patterns and messages.
BLOCK_COMMENT = r"/\*[\s\S]*?\*/"
LINE_COMMENT = "--" + JS_NOT_LINE_END + "*"
# ";" or the word GO (any case); the look-behind runs only where GO matched.
STATEMENT_SPLIT = ";|[Gg][Oo](?<![A-Za-z0-9_][Gg][Oo])(?![A-Za-z0-9_])"
DYNAMIC_SQL = "(?i)" + _words("EXEC", "sp_executesql", "xp_", "sp_")
WRITE_SQL = "(?i)" + _words("INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "TRUNCATE", "MERGE", "CREATE")
EXTERNAL_ROWSET = "(?i)" + _words("OPENROWSET", "OPENQUERY")
DECLARE_HEAD = "(?i)^DECLARE" + WB_AFTER
QUERY_HEAD = "(?i)^(?:WITH|SELECT)" + WB_AFTER
PAREN_SELECT_HEAD = "(?i)^\\(" + JS_WS + "*SELECT" + WB_AFTER
QUERY_WORD = "(?i)" + _words("WITH", "SELECT")
PARAM_AFTER_WORD = "(?i)(?<=[A-Za-z0-9_])@(?:AsOfDate|EndDate|StartDate)" + WB_AFTER
ERR_DYNAMIC = "Dynamic SQL is not allowed."
ERR_ONLY_SELECT = "Only SELECT statements are allowed."
ERR_EXTERNAL = "External rowset access is not allowed."
ERR_SINGLE = "Only a single statement is allowed."
ERR_EMPTY = "Query must be a non-empty string."
DEFAULT_DECLARES = [
    "DECLARE @AsOfDate date = CAST(GETDATE() AS date);",
    "DECLARE @EndDate date = CAST(GETDATE() AS date);",
    "DECLARE @StartDate date = DATEADD(day, -14, GETDATE());",
]
SHEET_FORBIDDEN = r"[\\/?*\[\]:]"
SHEET_DEFAULT = "Sheet1"
SHEET_MAX_CHARS = 31


# The same JavaScript whitespace set as characters, for ``btrim``.
JS_WS_CHARS = ("\t\n\x0b\x0c\r \u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
               + "\u2028\u2029\u202f\u205f\u3000\ufeff")


ASCII_WS_CHARS = "\t\n\x0b\x0c\r "
EXOTIC_WS_CHARS = "".join(ch for ch in JS_WS_CHARS if ch not in ASCII_WS_CHARS)


def js_trim(c: Column) -> Column:
    """JavaScript ``String.prototype.trim`` (no regex: a character-set trim)."""
    return F.btrim(c, F.lit(JS_WS_CHARS))


def collapse_ws(c: Column) -> Column:
    """``s.replace(/\\s+/g, ' ').trim()``."""
    return js_trim(F.regexp_replace(c, f"{JS_WS}+", " "))


def _ascii_blanks(c: Column) -> Column:
    """Map the non-ASCII JavaScript blanks to a space (a character map, no
    regex).  Applied after comment stripping (U+2028/2029 end a ``--``
    comment); afterwards Java's ASCII ``\\s`` is exactly JavaScript's ``\\s``."""
    return F.translate(c, EXOTIC_WS_CHARS, " " * len(EXOTIC_WS_CHARS))


def strip_comments(text: Column, cr: str) -> Column:
    """Drop ``/*...*/`` and ``--...`` comments; ``\\r`` becomes ``cr``; trim."""
    c = F.regexp_replace(text, BLOCK_COMMENT, " ")
    c = F.regexp_replace(c, LINE_COMMENT, " ")
    return js_trim(F.regexp_replace(c, "\r", cr))


def statements(text: Column, cr: str = "") -> Column:
    """T1 core: the array of normalised, non-empty statements of a script."""
    parts = F.split(_ascii_blanks(strip_comments(text, cr)), STATEMENT_SPLIT, -1)
    ascii_trim = lambda x: F.btrim(x, F.lit(ASCII_WS_CHARS))
    trimmed = F.filter(F.transform(parts, ascii_trim), lambda s: s != "")
    return F.transform(trimmed, lambda x: ascii_trim(F.regexp_replace(x, "\\s+", " ")))


def split_statements(scripts: DataFrame, id_col: str = "script_id", text_col: str = "text") -> DataFrame:
    """One row per statement: (script_id, stmt_no, statement)."""
    return scripts.select(F.col(id_col).alias("script_id"),
                          F.posexplode(statements(F.col(text_col))).alias("stmt_no", "statement"))


# What a batch is made of: comments (also one within another), quoted text, words, single characters.
_LINE_COMMENT_TOKEN = r"--[^\n\r]*+"
_BLOCK_COMMENT_TOKEN = r"/\*(?:[^*/]|\*(?!/)|/(?!\*)|/\*(?s:.*?)\*/)*+\*/"
_QUOTED_TOKEN = "|".join(q + r"[^\\" + q + r"]*+(?:\\(?s:.)[^\\" + q + "]*+)*+" + q for q in "'\"") + "|`[^`]*+`"
_BATCH_TOKEN = (f"{_LINE_COMMENT_TOKEN}|{_BLOCK_COMMENT_TOKEN}|{_QUOTED_TOKEN}"
                r"|[A-Za-z0-9_@#$]++|[\s]++|[^A-Za-z0-9_@#$'\"`;()\s/-]++|(?s:.)")
_BATCH_STATE = ("struct<at:int,depth:int,start:int,rest:int,end:int,phase:int,use:boolean,fresh:boolean,more:boolean,"
                "setup:array<string>>")
_BETWEEN, _SETUP, _QUERY, _AFTER = 0, 1, 2, 3


def split_batch(text: Column) -> Column:
    """R2: struct(setup array, query, more) of a batch: its setup lines (``USE``, ``SET``, ``DECLARE``, ``GO``) and
    the text that follows them, unchanged up to its end.

    A fold over the batch's tokens, so quotes and comments hide what stands in them.  A setup line ends at a ``;``,
    or where the next line or the query begins (a word outside brackets; after ``USE`` also an opening one).  The query
    ends at a ``;`` or at a line that is ``GO``; ``more`` tells of anything but comments, ``;`` and ``GO`` after that."""
    tokens = F.regexp_extract_all(text, F.lit(f"({_BATCH_TOKEN})"), F.lit(1))
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("start"), F.lit(0).alias("rest"),
                     F.lit(None).cast("int").alias("end"), F.lit(_BETWEEN).alias("phase"), F.lit(False).alias("use"),
                     F.lit(True).alias("fresh"), F.lit(False).alias("more"),
                     F.array().cast("array<string>").alias("setup")).cast(_BATCH_STATE)

    def step(acc: Column, token: Column) -> Column:
        word, phase = F.upper(token), acc["phase"]
        blank = F.regexp_replace(token, r"\s+", "") == ""
        silent = blank | token.startswith("--") | token.startswith("/*")
        depth = acc["depth"] + F.when(token == "(", 1).when(token == ")", -1).otherwise(0)
        top, size = acc["depth"] == 0, F.length(token)
        opens = top & word.isin("USE", "SET", "DECLARE")
        go, end = top & (word == "GO"), top & (token == ";")
        asks = top & (word.isin("WITH", "SELECT") | (acc["use"] & (token == "(")))
        line = F.trim(F.substring(text, acc["start"] + 1, acc["at"] - acc["start"]))
        go_line = F.when(go & acc["fresh"], F.substring(text, acc["at"] + size + 1, F.length(text))
                         .rlike(r"\A[ \t\r]*(\n|--|\z)")).otherwise(F.lit(False))
        closes = (phase == _QUERY) & (end | go_line)
        done = (phase == _SETUP) & (opens | go | end | asks)
        between = (phase == _BETWEEN) | done
        after = F.when(~between, F.when(closes, F.lit(_AFTER)).otherwise(phase)) \
            .when(opens, F.lit(_SETUP)).when(go | end | (silent & ~done), F.lit(_BETWEEN)).otherwise(F.lit(_QUERY))
        rest = F.when(between & (opens | go | end), acc["at"] + size).when(done, acc["at"]).otherwise(acc["rest"])
        return F.struct(
            (acc["at"] + size).alias("at"), F.when(depth < 0, 0).otherwise(depth).alias("depth"),
            F.when(between & opens, acc["at"]).otherwise(acc["start"]).alias("start"), rest.alias("rest"),
            F.when(closes, acc["at"]).otherwise(acc["end"]).alias("end"), after.alias("phase"),
            F.when(between, opens & (word == "USE")).otherwise(acc["use"]).alias("use"),
            F.when(token.contains("\n"), blank).otherwise(acc["fresh"] & blank).alias("fresh"),
            (acc["more"] | ((phase == _AFTER) & ~(silent | end | go))).alias("more"),
            F.when(done, F.concat(acc["setup"], F.array(line))).otherwise(acc["setup"]).alias("setup")).cast(_BATCH_STATE)

    def finish(acc: Column) -> Column:
        unfinished = acc["phase"] == _SETUP
        line = F.trim(F.substring(text, acc["start"] + 1, F.length(text)))
        return F.struct(
            F.when(unfinished, F.concat(acc["setup"], F.array(line))).otherwise(acc["setup"]).alias("setup"),
            F.when(acc["phase"].isin(_BETWEEN, _SETUP), F.lit("")).otherwise(F.substring(
                text, acc["rest"] + 1, F.coalesce(acc["end"], F.length(text)) - acc["rest"])).alias("query"),
            acc["more"].alias("more"))

    return F.aggregate(tokens, start, step, finish)


# Lower-case literals one of which every match of the keyword patterns
# contains: a cheap substring test decides most statements without a regex.
DYNAMIC_HINTS = ["exec", "xp_", "sp_"]
WRITE_HINTS = ["insert", "update", "delete", "drop", "alter", "truncate", "merge", "create"]
EXTERNAL_HINTS = ["openrowset", "openquery"]


def _gated(s: Column, low: Column, pattern: str, hints: list[str]) -> Column:
    hit = None
    for h in hints:
        c = low.contains(h)
        hit = c if hit is None else hit | c
    return F.when(hit, s.rlike(pattern)).otherwise(F.lit(False))


def _first_word(s: Column) -> Column:
    return F.upper(F.split(s, " ", 2)[0])


def _with_lower(s: Column) -> Column:
    return F.struct(s.alias("s"), F.lower(s).alias("low"))


def _statement_kind(x: Column) -> Column:
    """Classify one normalised statement ``struct(s, low)``: an error text
    prefixed ``E:``, ``skip`` (USE/SET/DECLARE), ``Q`` (WITH/SELECT) or
    ``P`` ((SELECT)."""
    s, low = x["s"], x["low"]
    fw = _first_word(s)
    return (F.when(fw == "GO", F.lit("skip"))
            .when(_gated(s, low, DYNAMIC_SQL, DYNAMIC_HINTS), F.lit("E:" + ERR_DYNAMIC))
            .when(_gated(s, low, WRITE_SQL, WRITE_HINTS), F.lit("E:" + ERR_ONLY_SELECT))
            .when(_gated(s, low, EXTERNAL_ROWSET, EXTERNAL_HINTS), F.lit("E:" + ERR_EXTERNAL))
            .when(fw.isin("USE", "SET") | s.rlike(DECLARE_HEAD), F.lit("skip"))
            .when(s.rlike(QUERY_HEAD), F.lit("Q"))
            .when(s.rlike(PAREN_SELECT_HEAD), F.lit("P"))
            .otherwise(F.lit("E:" + ERR_ONLY_SELECT)))


def _audit_fold(kinds: Column) -> Column:
    """Walk the statement kinds in order: the first failing one decides; a
    second WITH/SELECT fails; ``(SELECT`` only counts.  Returns struct(n, err)."""
    init = F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("err"))

    def step(acc, k):
        n1 = acc["n"] + 1
        return (F.when(acc["err"].isNotNull(), acc)
                .when(k.startswith("E:"), F.struct(acc["n"].alias("n"), F.substring(k, F.lit(3), F.length(k)).alias("err")))
                .when(k == "Q", F.struct(n1.alias("n"),
                                         F.when(n1 > 1, F.lit(ERR_SINGLE)).alias("err")))
                .when(k == "P", F.struct(n1.alias("n"), F.lit(None).cast("string").alias("err")))
                .otherwise(acc))

    return F.aggregate(kinds, init, step)


def audit_scripts(scripts: DataFrame, id_col: str = "script_id", text_col: str = "text") -> DataFrame:
    """(script_id, valid, error) per script.

    Each stage is its own column, so every regex runs once per statement
    (an expression referenced twice inside a lambda would run twice)."""
    df = scripts.select(F.col(id_col).alias("script_id"), F.col(text_col).alias("_text"))
    df = df.withColumn("_stmts", F.transform(statements(F.col("_text"), cr=" "), _with_lower))
    df = df.withColumn("_kinds", F.transform("_stmts", _statement_kind))
    df = df.withColumn("_fold", _audit_fold(F.col("_kinds")))
    err = F.coalesce(F.col("_fold.err"), F.when(F.col("_fold.n") != 1, F.lit(ERR_ONLY_SELECT)))
    blank = F.col("_text").isNull() | (js_trim(F.col("_text")) == "")
    df = df.withColumn("_err", F.when(blank, F.lit(ERR_EMPTY)).otherwise(err))
    return df.select("script_id", F.col("_err").isNull().alias("valid"), F.col("_err").alias("error"))


def audit_text(text: Column) -> Column:
    """T2 on one text as a single expression: struct(valid, error).

    For a handful of strings (validating a run's queries); corpora go
    through ``audit_scripts``."""
    fold = _audit_fold(F.transform(F.transform(statements(text, cr=" "), _with_lower), _statement_kind))
    err = F.coalesce(fold["err"], F.when(fold["n"] != 1, F.lit(ERR_ONLY_SELECT)))
    blank = text.isNull() | (js_trim(text) == "")
    return (F.when(blank, F.struct(F.lit(False).alias("valid"), F.lit(ERR_EMPTY).alias("error")))
            .otherwise(F.struct(err.isNull().alias("valid"), err.alias("error"))))


def _split_at_query(x: Column) -> Column:
    """struct(s, rest) -> struct(head, query): cut at the first WITH/SELECT word, where ``rest`` begins."""
    s, rest = x["s"], x["rest"]
    has_q = rest != ""
    query = F.when(has_q, js_trim(rest))
    head = F.substring(s, F.lit(1), F.length(s) - F.length(rest))
    return F.struct(F.when(has_q, js_trim(head)).otherwise(s).alias("head"),
                    query.alias("query"), F.lower(query).alias("low"))


def _setup_and_query(x: Column) -> Column:
    """struct(head, query) -> struct(setup, query): the setup text kept for
    later queries (USE / SET / DECLARE prefix, DECLARE commented out) and
    the query when the audit accepts it (else NULL)."""
    head, query, low = x["head"], x["query"], x["low"]
    is_declare = head.rlike(DECLARE_HEAD)
    keep = (head != "") & (_first_word(head).isin("USE", "SET") | is_declare)
    ok = (query.isNotNull() & ~_gated(query, low, DYNAMIC_SQL, DYNAMIC_HINTS)
          & ~_gated(query, low, WRITE_SQL, WRITE_HINTS) & ~_gated(query, low, EXTERNAL_ROWSET, EXTERNAL_HINTS)
          & (query.rlike(QUERY_HEAD) | query.rlike(PAREN_SELECT_HEAD)))
    setup = F.when(keep, F.when(is_declare, F.concat(F.lit("-- "), head)).otherwise(head))
    return F.struct(setup.alias("setup"), F.when(ok, query).alias("query"))


def extract_queries(scripts: DataFrame, id_col: str = "script_id", text_col: str = "text") -> DataFrame:
    """(script_id, query_no, setup, query) for every accepted query.

    ``setup`` is the USE/SET/DECLARE text met so far in the script
    (DECLARE lines commented out); ``query`` is the text the runner would
    send: setup lines, the parameter defaults when the query needs them,
    then the query.  Stages are separate columns so that each regex runs
    once per statement."""
    df = scripts.select(F.col(id_col).alias("script_id"), statements(F.col(text_col)).alias("_stmts"))
    df = df.withColumn("_cut", F.transform("_stmts", lambda s: F.struct(
        s.alias("s"), F.regexp_extract(s, f"(?s){QUERY_WORD}.*", 0).alias("rest"))))
    df = df.withColumn("_cut", F.transform("_cut", _split_at_query))
    df = df.withColumn("_parts", F.transform("_cut", _setup_and_query))
    # Setups and queries apart, each with its statement number: a query then sees only the setups, not all statements.
    numbered = F.transform("_parts", lambda p, i: F.struct(i.alias("no"), p["setup"].alias("setup"), p["query"].alias("query")))
    df = df.withColumn("_all", numbered)
    df = df.select("script_id", F.filter("_all", lambda p: p["setup"].isNotNull()).alias("_setups"),
                   F.filter("_all", lambda p: p["query"].isNotNull()).alias("_queries"))
    rows = df.select("script_id", "_setups", F.posexplode("_queries").alias("query_no", "_q"))
    rows = rows.select("script_id", "query_no", F.struct(F.col("_q.query").alias("query"), F.transform(
        F.filter("_setups", lambda s: s["no"] <= F.col("_q.no")), lambda s: s["setup"]).alias("setup")).alias("q"))
    q = F.col("q.query")
    defaults = F.when(q.rlike(PARAM_AFTER_WORD), F.array(*[F.lit(d) for d in DEFAULT_DECLARES])) \
        .otherwise(F.array().cast("array<string>"))
    return rows.select(
        "script_id", "query_no",
        F.array_join(F.col("q.setup"), "\n").alias("setup"),
        F.array_join(F.concat(F.col("q.setup"), defaults, F.array(q)), "\n").alias("query"))


def sanitize_name(name: Column) -> Column:
    """T4 worksheet / output name: blank -> Sheet1; ``\\ / ? * [ ] :`` -> ``_``;
    collapse blanks, then underscores; trim; first 31 UTF-16 units (a pair of
    surrogates at the cut is dropped whole)."""
    base = F.coalesce(F.nullif(js_trim(F.coalesce(name.cast("string"), F.lit(""))), F.lit("")),
                      F.lit(SHEET_DEFAULT))
    s = F.regexp_replace(base, SHEET_FORBIDDEN, "_")
    s = F.regexp_replace(s, f"{JS_WS}+", " ")
    s = js_trim(F.regexp_replace(s, "_+", "_"))
    units = F.encode(s, "UTF-16BE")
    cut = F.substring(units, 1, 2 * SHEET_MAX_CHARS)
    last = F.hex(F.substring(cut, 2 * SHEET_MAX_CHARS - 1, 1))          # D8..DB: the first half of a pair
    whole = F.when(last.between("D8", "DB"), F.substring(cut, 1, 2 * SHEET_MAX_CHARS - 2)).otherwise(cut)
    return F.when(F.octet_length(units) <= 2 * SHEET_MAX_CHARS, s).otherwise(F.decode(whole, "UTF-16BE"))


def report_stamp(prefix: Column | str, date: Column, ext: str = "") -> Column:
    """T5 ``<prefix>_YYYYMMDD`` (+ optional extension)."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(p, F.lit("_"), F.date_format(date, "yyyyMMdd"), F.lit(ext))
