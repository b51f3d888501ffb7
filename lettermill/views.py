"""Views derived from the driver tables, dressed with what e-mail looks like.

The tables hold plain prose. ``EMAILS`` and ``PARTS`` add sign-offs, quotes,
headers and part layouts to every row; the SQL text is valid in Spark and in
DuckDB, so both sides of a check read the same rows. Every row and the whole of
its text is in; messages without a body are rows of their own, with ids from 1,000,000,000.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.plans.parallelism import spread
from lettermill.sources.mailbox import mailbox_record

EMAILS = """
select doc_id, source, lang,
  concat('Subject ', cast(doc_id as string)) as subject,
  case when doc_id % 4 = 0 then '' else concat('user', cast(doc_id % 50 as string), '@example.com') end as to_addr,
  case doc_id % 10
    when 0 then text
    when 1 then concat(text, chr(10), chr(10), 'Kind regards,', chr(10), 'Jan')
    when 2 then concat('> quoted', chr(10), '| quoted too', chr(10), text, chr(10), '-- ', chr(10), 'Jan')
    when 3 then concat(text, chr(10), 'On 10 Feb 2023, at 11:49, Jan wrote:', chr(10), text)
    when 4 then concat('Hoi', chr(10), '***', chr(10), text, chr(10), 'Tel: 06-1234', chr(10), chr(10), chr(10), chr(10), '  done   now, don''t wait')
    when 5 then concat(text, chr(10), chr(10), 'Groeten,', chr(10), 'Jan')
    when 6 then concat('Thanks for all.', chr(10), text)
    when 7 then concat('Hi  there', chr(10), chr(10), text, chr(10), 'Op ma 3 jan schreef Piet:', chr(10), '> x')
    when 8 then concat(text, chr(10), 'Thank you for your help, I''m pleased to hear it! Could you reply?', chr(10), '/ Regards')
    else concat('Hey Jan, it''s cool.', chr(10), text, chr(10), '---', chr(10), 'lost line', chr(10), 'Met vriendelijke groet, Jan')
  end as body
from documents
union all
select 1000000000 + doc_id, source, lang, concat('Empty ', cast(doc_id as string)), 'nobody@example.com', '' from documents where doc_id % 10 = 5
"""

# Layout of a message by doc_id % 5: HTML only, HTML then plain, plain then HTML,
# nothing usable but attachments (one of them with a capital A, which counts as
# text), and a single part that is taken although it is called an attachment.
PARTS = """
select * from (
  select d.doc_id as msg_id, d.doc_id % 5 <> 4 as multipart, 0 as part_no,
    case d.doc_id % 5 when 2 then 'text/plain' when 3 then 'image/png' else 'text/html' end as content_type,
    case when d.doc_id % 5 = 4 then 'attachment; filename=single.html' end as disposition,
    case when d.doc_id % 5 in (0, 1) then coalesce(p.html, concat('<p>', d.text, '</p>'))
      when d.doc_id % 5 = 4 then concat(coalesce(p.html, ''), '<p>', d.text, '</p>') else d.text end as payload
  from documents d left join pages p on p.page_id = d.doc_id
  union all
  select d.doc_id, true, 1,
    case d.doc_id % 5 when 0 then 'image/png' when 1 then 'text/plain' when 2 then 'text/html' when 3 then 'text/html' end,
    case when d.doc_id % 5 = 3 then 'attachment; filename=page.html' end,
    case when d.doc_id % 5 in (2, 3) then coalesce(p.html, concat('<p>', d.text, '</p>')) else d.text end
  from documents d left join pages p on p.page_id = d.doc_id
  union all
  select doc_id, true, 2,
    case when doc_id % 5 <> 4 then 'text/plain' end,
    case when doc_id % 10 = 3 then 'Attachment; filename=capital.txt' else 'attachment; filename=a.txt' end,
    concat('attached ', text)
  from documents
) dressed
where content_type is not null
"""

# All conversations, and one that strings all of their turns together.
TURNS = """
select conv_id, turn, role, text from conversations
union all
select -1, conv_id * 100000 + turn, role, text from conversations
"""

HTML_BODY = "<html><body><p>{}</p><p>see <a href=\"http://example.com\">this</a></p></body></html>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EMAILS.replace("from documents", "from {documents}"), documents=table(spark, sf_dir, "documents"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = PARTS.replace("documents", "{documents}").replace("join pages", "join {pages}")
    return spark.sql(sql, documents=table(spark, sf_dir, "documents"), pages=table(spark, sf_dir, "pages"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = TURNS.replace("from conversations", "from {conversations}")
    return spark.sql(sql, conversations=table(spark, sf_dir, "conversations"))


def mail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every e-mail as mailbox record text.

    By doc_id % 4: single plain part; HTML and base64 plain part; HTML part and
    an attachment; the body as an attachment only.
    """
    body = F.col("body")
    to_line = F.when(F.col("to_addr") != "", F.concat(F.lit("\nTo: "), F.col("to_addr"))).otherwise("")
    top = F.concat(F.lit("Subject: "), F.col("subject"), to_line, F.lit("\nFrom: me@example.com\nMIME-Version: 1.0\n"))

    def part(headers: str, content: Column) -> Column:
        return F.concat(F.lit(f"--cut\n{headers}\n\n"), content, F.lit("\n"))

    before, after = HTML_BODY.split("{}")
    html = part("Content-Type: text/html; charset=utf-8", F.concat(F.lit(before), body, F.lit(after)))
    encoded = part(
        "Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64",
        F.base64(body.cast("binary")),
    )
    note = "Content-Type: text/plain; charset=utf-8\nContent-Disposition: attachment; filename=a.txt"
    attached = part(note, F.lit("attached"))
    end = F.lit("--cut--")
    layout = F.col("doc_id") % 4
    kind = F.when(layout == 0, "Content-Type: text/plain; charset=utf-8").otherwise(
        'Content-Type: multipart/mixed; boundary="cut"'
    )
    content = (
        F.when(layout == 0, body)
        .when(layout == 1, F.concat(html, encoded, end))
        .when(layout == 2, F.concat(html, attached, end))
        .otherwise(F.concat(part(note, body), end))
    )
    return emails(spark, sf_dir).select(
        F.concat("source", F.lit(".mbox")).alias("source"),
        "doc_id",
        mailbox_record(F.concat(top, kind), content).alias("record"),
    )
