"""Text and formula clean-up over F9 and F10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import latex as L
from ..functions import text as X
from . import query

DL = ["doc_id", "line_no"]
WIDE = "ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ０１２３４５６７８９"
NARROW = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@query("FN1_full_to_half", ["noisy"], f"SELECT doc_id,line_no,TRANSLATE(t||'（！）','{WIDE}（！）','{NARROW}(!)') AS text FROM noisy")
def fn1(t):
    return t.noisy.select(*DL, X.full_to_half(F.concat("t", F.lit("（！）"))).alias("text"))


@query("FN2_full_to_half_letters", ["noisy"], f"SELECT doc_id,line_no,TRANSLATE(t||'（！）','{WIDE}','{NARROW}') AS text FROM noisy")
def fn2(t):
    return t.noisy.select(*DL, X.full_to_half_letters(F.concat("t", F.lit("（！）"))).alias("text"))


@query("FN3_hyphen_at_line_end", ["noisy"], "SELECT doc_id,line_no,REGEXP_MATCHES(txt||CASE WHEN line_no%3=0 THEN '- ' ELSE '' END,'[A-Za-z]+-\\s*$') hyphen FROM noisy")
def fn3(t):
    tail = F.when(F.col("line_no") % 3 == 0, "- ").otherwise("")
    return t.noisy.select(*DL, X.ends_with_hyphen(F.concat("txt", tail)).alias("hyphen"))


@query("FN4_ligatures", ["noisy"], "SELECT doc_id,line_no,REPLACE(REPLACE(t,'ﬀ','ff'),'ﬁ','fi') AS text FROM noisy")
def fn4(t):
    return t.noisy.select(*DL, X.expand_ligatures(F.col("t")).alias("text"))


@query("FN5_control_marks", ["noisy"], "SELECT doc_id,line_no,REPLACE(txt,' ','-') AS text FROM noisy")
def fn5(t):
    dirty = F.concat(F.replace("txt", F.lit(" "), F.lit("\u0002")), F.lit("\r\n"))
    return t.noisy.select(*DL, X.drop_control_marks(dirty).alias("text"))


@query("FN6_escape_markdown", ["noisy"], "SELECT doc_id,line_no,REPLACE(REPLACE(REPLACE(REPLACE(txt||'*`~$_','*','\\*'),'`','\\`'),'~','\\~'),'$','\\$') AS text FROM noisy")
def fn6(t):
    return t.noisy.select(*DL, X.escape_markdown(F.concat("txt", F.lit("*`~$_"))).alias("text"))


@query("FN7_formula_delimiters", ["formulas"], """
SELECT f_id,'$'||tex||'$' inline,chr(10)||'$$'||chr(10)||tex||chr(10)||'$$'||chr(10) display,'\\('||tex||'\\)' own FROM formulas""")
def fn7(t):
    x = F.col("tex")
    return t.formulas.select("f_id", X.wrap_formula(x).alias("inline"), X.wrap_formula(x, True).alias("display"), X.wrap_formula(x, False, "\\(", "\\)").alias("own"))


@query("FN8_display_marks", ["formulas"], "SELECT f_id,TRIM(tex) clean FROM formulas")
def fn8(t):
    marked = F.when(F.col("f_id") % 2 == 0, F.concat(F.lit("\\[ "), "tex", F.lit(" \\]"))).otherwise(F.col("tex"))
    return t.formulas.select("f_id", X.strip_display_marks(marked).alias("clean"))


@query("FN9_code_fences", ["noisy"], "SELECT doc_id,line_no,REGEXP_REPLACE(txt,'^\\s+|\\s+$','','g') code FROM noisy")
def fn9(t):
    k = F.col("line_no") % 3
    fenced = F.when(k == 0, F.concat(F.lit("```python\n"), "txt", F.lit("\n```"))).when(k == 1, F.concat(F.lit("```\n"), "txt")).otherwise(F.col("txt"))
    return t.noisy.select(*DL, X.strip_code_fence(fenced).alias("code"))


@query("FN10_unbracket", ["noisy"], """
SELECT doc_id,line_no,CASE line_no%3 WHEN 0 THEN '['||txt||'] and [2]' WHEN 1 THEN '\\['||txt ELSE txt END AS text FROM noisy""")
def fn10(t):
    k = F.col("line_no") % 3
    marked = F.when(k == 0, F.concat(F.lit("\\["), "txt", F.lit("\\] and \\[2\\]"))).when(k == 1, F.concat(F.lit("\\["), "txt")).otherwise(F.col("txt"))
    return t.noisy.select(*DL, X.unbracket(marked).alias("text"))


@query("FN11_inline_formulas", ["noisy"], """
SELECT doc_id,line_no,n,type,content FROM (
 SELECT doc_id,line_no,CAST(0 AS BIGINT) n,'text' AS type,txt||' ' content FROM noisy WHERE line_no%3=0 UNION ALL
 SELECT doc_id,line_no,1,'inline_equation','a+b' FROM noisy WHERE line_no%3=0 UNION ALL
 SELECT doc_id,line_no,2,'text',' so ' FROM noisy WHERE line_no%3=0 UNION ALL
 SELECT doc_id,line_no,3,'inline_equation','c' FROM noisy WHERE line_no%3=0 UNION ALL
 SELECT doc_id,line_no,0,'text',CASE line_no%3 WHEN 1 THEN txt||'\\(x' ELSE txt END FROM noisy WHERE line_no%3<>0) z""")
def fn11(t):
    k = F.col("line_no") % 3
    marked = F.when(k == 0, F.concat("txt", F.lit(" \\( a+b \\) so \\(c\\) "))).when(k == 1, F.concat("txt", F.lit("\\(x"))).otherwise(F.col("txt"))
    return t.noisy.select(*DL, F.posexplode(X.split_inline_formulas(marked)).alias("n", "s")).select(*DL, "n", "s.type", "s.content")


@query("FN11_code_or_algorithm", ["noisy"], "SELECT doc_id,line_no,CASE WHEN line_no%3=0 THEN 'algorithm' ELSE 'code' END kind FROM noisy")
def fn11_code(t):
    k = F.col("line_no") % 3
    marked = F.when(k == 0, F.concat("txt", F.lit("\\(a\\)"))).when(k == 1, F.concat("txt", F.lit("\\(x"))).otherwise(F.col("txt"))
    return t.noisy.select(*DL, X.code_kind(F.lit("code"), marked).alias("kind"))


@query("FN12_clean_formulas", ["formulas"], """
SELECT f_id,CASE f_id%6 WHEN 2 THEN SUBSTRING(tex,2) WHEN 3 THEN tex||' \\end{array}' WHEN 4 THEN '\\alpha + \\hat y ' WHEN 5 THEN SUBSTRING(tex,6) ELSE tex END clean FROM formulas""")
def fn12(t):
    return L.clean_formulas(t.formulas).select("f_id", "clean")


@query("FN13_clean_recognised_formulas", ["formulas"], """
SELECT f_id,CASE f_id%6 WHEN 3 THEN tex||' 公式 \\end{array}' WHEN 4 THEN REPLACE(tex,'\\upalpha','\\alpha')||' 公式' WHEN 5 THEN SUBSTRING(tex,6)||' 公式' ELSE tex||' 公式' END clean FROM formulas""")
def fn13(t):
    marked = t.formulas.withColumn("tex", F.concat("tex", F.lit(' "\\text{ 公式 }"')))
    return L.clean_recognised_formulas(marked).select("f_id", "clean")


@query("FN14_cjk_or_not", ["noisy"], """
SELECT doc_id,line_no,cjk*10>=3*solid AND solid>0 cjk FROM (SELECT doc_id,line_no,CASE WHEN line_no%2=0 THEN 20 ELSE 0 END cjk,
 LENGTH(REGEXP_REPLACE(txt,'\\s','','g'))+CASE WHEN line_no%2=0 THEN 20 ELSE 0 END solid FROM noisy) z""")
def fn14(t):
    mixed = F.when(F.col("line_no") % 2 == 0, F.concat("txt", F.lit("漢字かなカナ한글漢字かなカナ한글漢字かな"))).otherwise(F.col("txt"))
    return t.noisy.select(*DL, X.is_cjk(mixed).alias("cjk"))


@query("FN15_hashes", ["documents"], """
SELECT doc_id,UPPER(MD5(text)) bytes_md5,MD5(text) str_md5,SHA256(text) str_sha256,MD5('{"doc_id": '||doc_id||', "lang": "'||lang||'"}') dict_md5 FROM documents""")
def fn15(t):
    x = F.col("text").cast("binary")
    return t.documents.select("doc_id", X.md5_upper(x).alias("bytes_md5"), F.md5(x).alias("str_md5"), F.sha2(x, 256).alias("str_sha256"),
                              X.canonical_md5(F.struct("lang", "doc_id"), ["lang", "doc_id"]).alias("dict_md5"))


@query("FN16_file_names", ["documents"], """
SELECT doc_id,lang||'_a b'||doc_id||'é.pdf' safe,CASE WHEN doc_id%2=0 THEN '_x' ELSE 'unnamed' END hidden,'paper'||doc_id||'_v_2' stem FROM documents""".replace("_a b", "_a_b"))
def fn16(t):
    name = F.concat(F.lit("../"), "lang", F.lit("/?a b"), F.col("doc_id").cast("string"), F.lit("é.pdf"))
    hidden = F.when(F.col("doc_id") % 2 == 0, ".x").otherwise("///..")
    path = F.concat(F.lit("/in/"), F.concat(F.lit("paper"), F.col("doc_id").cast("string")), F.lit(" v 2.pdf"))
    path = F.replace(path, F.lit(" v"), F.lit("-v"))
    return t.documents.select("doc_id", X.safe_file_name(name).alias("safe"), X.safe_file_name(hidden).alias("hidden"), X.safe_stem(path).alias("stem"))


@query("FN17_trim_to_table", ["page_tables"], "SELECT doc_id,page_idx,CASE WHEN doc_id%2=0 THEN html||'x'||html ELSE 'none' END AS table_html FROM page_tables")
def fn17(t):
    page = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<html>\n"), "html", F.lit("x"), "html", F.lit("</html>"))).otherwise(F.lit("none"))
    return t.page_tables.select("doc_id", "page_idx", X.trim_to_table(page).alias("table_html"))


@query("FN18_parse_list", ["documents"], "SELECT doc_id,source||'|b|'||lang||'|'||doc_id items FROM documents")
def fn18(t):
    raw = F.concat("source", F.lit(", 'b'\n\""), "lang", F.lit('"  ,, '), F.col("doc_id").cast("string"), F.lit(" "))
    return t.documents.select("doc_id", F.array_join(X.parse_list(raw), "|").alias("items"))


@query("FN19_escape_html", ["noisy"], "SELECT doc_id,line_no,'&lt;b&gt; &amp;amp; &quot;&#x27;'||REPLACE(REPLACE(REPLACE(REPLACE(REPLACE(txt,'&','&amp;'),'<','&lt;'),'>','&gt;'),'\"','&quot;'),chr(39),'&#x27;') AS text FROM noisy")
def fn19(t):
    return t.noisy.select(*DL, X.escape_html(F.concat(F.lit("<b> &amp; \"'"), "txt")).alias("text"))


@query("FN20_right_to_left", ["noisy"], """
SELECT doc_id,line_no,ARRAY_TO_STRING(LIST_REVERSE(REGEXP_EXTRACT_ALL('אב '||txt||' גד','[a-zA-Z0-9 :*./%+-]+|[^a-zA-Z0-9 :*./%+-]')),'') AS text FROM noisy""")
def fn20(t):
    return t.noisy.select(*DL, X.right_to_left(F.concat(F.lit("אב "), "txt", F.lit(" גד"))).alias("text"))


@query("FN21_word_runs", ["noisy"], """
SELECT doc_id,line_no,ARRAY_TO_STRING(REGEXP_EXTRACT_ALL('中文VGG-16 1.5. '||txt,'[一-鿿]+|[a-zA-Z0-9](?:[a-zA-Z0-9-]|\\.[0-9])*'),'|') words FROM noisy""")
def fn21(t):
    return t.noisy.select(*DL, F.array_join(X.word_runs(F.concat(F.lit("中文VGG-16 1.5. "), "txt"))["word"], "|").alias("words"))


@query("FN25_task_options", ["task_events"], """
SELECT task_id,event_id,'{"lang":"'||event_type||'","formula_enable":'||CASE WHEN worker=0 THEN 'true' ELSE 'false' END||'}' options,event_type AS lang,worker=0 formula_enable FROM task_events""")
def fn25(t):
    packed = t.task_events.withColumn("options", F.to_json(F.struct(F.col("event_type").alias("lang"), (F.col("worker") == 0).alias("formula_enable"))))
    return packed.withColumn("o", F.from_json("options", "lang string, formula_enable boolean")).select("task_id", "event_id", "options", "o.lang", "o.formula_enable")
