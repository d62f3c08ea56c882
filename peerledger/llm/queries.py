"""The operators applied to their whole tables, with the result columns that their contracts name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerledger.llm.alignment import align
from peerledger.llm.bpe import decode, encode
from peerledger.llm.chat_format import rotate
from peerledger.llm.exact_dedup import exact_dedup
from peerledger.llm.jaccard import near_duplicates
from peerledger.llm.language_id import held_out, predict, train
from peerledger.llm.metric_join import near_vectors
from peerledger.llm.mixing import mix
from peerledger.llm.registry import query, table
from peerledger.llm.sharding import shard
from peerledger.llm.spelling import spelling_forms, word_counts
from peerledger.llm.suffix_dedup import remove_repeats
from peerledger.llm.token_store import read_tokens, write_tokens
from peerledger.llm.url_filter import ALLOW, BLOCK, Rule, judge
from peerledger.llm.url_filter import train as train_urls
from peerledger.session import fresh_path

END_OF_DOCUMENT = 1


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


EXACT_DEDUP_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


@query("op9_exact_dedup", EXACT_DEDUP_SQL)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256")
    rows = exact_dedup(docs, carry=[F.col("doc_id"), digest])
    return rows.select("doc.doc_id", "keep_id", "group_size", "kept", "doc.text_sha256")


@query("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


@query("op2_source_mixing")
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(table(spark, sf_dir, "documents"), carry=[F.col("doc_id")])
    return rows.select("doc.doc_id", "size", "source_size", "target", "taken", "per_shard")


@query("op4_token_store")
def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-store")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), END_OF_DOCUMENT)
    return read_tokens(spark, path, digests=True).withColumnRenamed("key", "doc_id")


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = tokenizer_file("byte_bpe_50k.json")
    rows = decode(encode(table(spark, sf_dir, "documents"), tokenizer), tokenizer)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    held = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return predict(docs, model, ["doc_id", held]).drop("known")


JACCARD_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents
),
shingles as (
  select distinct doc_id, array_to_string(w[i : i + 3], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 2)) as i from words where len(w) >= 4) x
  union all select doc_id, array_to_string(w, ' ') from words where len(w) between 1 and 3
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as u, b.doc_id as v, count(*) as k from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2
),
links as (
  select u, v from shared join sizes a on a.doc_id = u join sizes b on b.doc_id = v where 100 * k >= 85 * (a.n + b.n - k)
),
reached as (select u, v from links union select r.u, l.v from reached r join links l on r.v = l.u),
least as (select u, min(v) as v from reached group by u)
select d.doc_id, coalesce(s.n, 0) as n_shingles, least(d.doc_id, l.v) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id left join least l on l.u = d.doc_id
"""


@query("op3_jaccard_join", JACCARD_SQL)
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85, carry=[F.col("doc_id")])
    return rows.select("doc.doc_id", "n_shingles", "component_id")


CHAT_SQL = """
with said as (select distinct conv_id, turn, role, coalesce(text, '') as text from conversations),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role nulls first, md5(text)) - 1 as pos from said
),
speakers as (select distinct conv_id, role as perspective from said where role is not null and role <> 'system'),
seen as (
  select p.conv_id, s.perspective, p.pos // 64 as part, p.pos, coalesce(p.role = s.perspective, false) as own, p.text,
         case when p.role = s.perspective then '<|assistant|>' when p.role = 'system' then '<|system|>'
              else '<|user name=' || coalesce(p.role, 'unknown') || '|>' end || chr(10) as head
  from placed p join speakers s on p.conv_id is not distinct from s.conv_id
),
pieces as (select *, head || text || '<|end|>' || chr(10) as piece from seen),
ends as (
  select *, sum(length(piece)) over (partition by conv_id, perspective order by pos) as total,
         sum(length(piece)) over (partition by conv_id, perspective, part order by pos) as stop
  from pieces
)
select conv_id, perspective, cast(part as integer) as part, cast(min(total - length(piece)) as bigint) as start,
       string_agg(piece, '' order by pos) as text, cast(count(*) as integer) as n_turns,
       coalesce(string_agg(case when own then cast(cast(stop - length(piece) + length(head) as bigint) as varchar) || '-'
                           || cast(cast(stop as bigint) as varchar) end, ',' order by pos), '') as masks
from ends group by conv_id, perspective, part
"""


@query("op10_chat_format", CHAT_SQL)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("masks", lambda m: F.concat_ws("-", m["begin"], m["end"]))
    return rows.withColumn("masks", F.array_join(spans, ","))


EMBEDDING_SQL = """
with recursive usable as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
  select a.vec_id as u, b.vec_id as v from usable a join usable b
  on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.98
),
reached as (select u, v from links union select r.u, l.v from reached r join links l on r.v = l.u),
least as (select u, min(v) as v from reached group by u),
counts as (select u, count(*) as n from links group by u)
select e.vec_id, coalesce(c.n, 0) as n_links, least(e.vec_id, l.v) as component_id, e.vec_id = least(e.vec_id, l.v) as kept
from embeddings e left join counts c on c.u = e.vec_id left join least l on l.u = e.vec_id
"""


@query("op8_embedding_join", EMBEDDING_SQL)
def op8_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


REPEATS_SQL = """
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (
  select doc_id, i, md5(substr(h, 2 * i + 1, 400)) as s from (select doc_id, h, unnest(range(0, len(h) // 2 - 199)) as i from docs) x
),
again as (select s from windows group by s having count(*) > 1),
hits as (select doc_id, i, i - lag(i) over (partition by doc_id order by i) as gap from windows where s in (select s from again)),
runs as (select doc_id, i, sum(case when gap is null or gap > 200 then 1 else 0 end) over (partition by doc_id order by i) as g from hits),
spans as (select doc_id, g, min(i) as b, max(i) + 200 as e from runs group by doc_id, g),
placed as (select *, coalesce(lag(e) over (partition by doc_id order by b), 0) as after from spans),
parts as (
  select d.doc_id, p.b, substr(h, 2 * after + 1, 2 * (p.b - after)) as part from placed p join docs d on d.doc_id = p.doc_id
  union all
  select d.doc_id, len(h), substr(h, 2 * coalesce(t.e, 0) + 1) from docs d left join (select doc_id, max(e) as e from spans group by doc_id) t on t.doc_id = d.doc_id
),
kept as (select doc_id, string_agg(part, '' order by b) as h from parts group by doc_id),
counts as (select doc_id, count(*) as n from spans group by doc_id)
select d.doc_id, len(d.h) // 2 as n_bytes, (len(d.h) - len(k.h)) // 2 as n_removed, coalesce(c.n, 0) as n_spans, sha256(unhex(k.h)) as kept_sha256
from docs d join kept k on k.doc_id = d.doc_id left join counts c on c.doc_id = d.doc_id
"""


@query("op7_suffix_dedup", REPEATS_SQL)
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"), carry=[F.col("doc_id")])
    removed = F.col("n_bytes") - F.octet_length("kept")
    n_spans = F.size("spans").cast("bigint").alias("n_spans")
    return rows.select("doc.doc_id", "n_bytes", removed.alias("n_removed"), n_spans, F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = align(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return rows.withColumn("groups_sha256", digest).drop("groups")


SPELLING_SQL = r"""
with recursive polynomials as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)
),
runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents
),
counted as (
  select run, length(run) as size, count(*) as n, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as h
  from runs where length(run) >= 6 group by doc_id, run
),
checked as (
  select run, size, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: cast('0x' || substr(h, cast(2 * i + 1 as integer), 2) as bigint))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as crc
  from counted, polynomials
),
made as (
  select n, case when crc % 199 = 0 then substr(run, 1, cast(crc % size as integer)) || substr(run, cast(crc % size + 2 as integer)) else run end as word from checked
),
words as (select word, cast(sum(n) as bigint) as n from made where length(word) >= 6 group by word having sum(n) >= 5),
holes as (select word, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail from (select word, cast(unnest(range(1, length(word) + 1)) as integer) as i from words) w),
pairs as (
  select a.word, b.word as near from holes a join holes b on a.head = b.head and a.tail = b.tail and a.word <> b.word
  union select h.word, w.word from holes h join words w on h.head || h.tail = w.word
  union select w.word, h.word from holes h join words w on h.head || h.tail = w.word
),
ranked as (
  select p.word, p.near, w.n as m, count(*) over (partition by p.word) as n_near, row_number() over (partition by p.word order by w.n desc, p.near) as place
  from pairs p join words w on w.word = p.near
),
forms as (
  select w.word, w.n, coalesce(r.n_near, 0) as n_near, case when r.m >= 5 * w.n then r.near end as form, case when r.m >= 5 * w.n then r.m end as form_n
  from words w left join ranked r on r.word = w.word and r.place = 1
),
steps as (select word, word as at from forms union all select s.word, f.form from steps s join forms f on f.word = s.at where f.form is not null),
ends as (select s.word, s.at as root from steps s join forms f on f.word = s.at where f.form is null)
select f.word, f.form, e.root, f.n, f.n_near, f.form_n from forms f join ends e on e.word = f.word
"""


@query("op13_spelling_variants", SPELLING_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = word_counts(table(spark, sf_dir, "documents"), least_length=6, least_count=5, deletion=199)
    return spelling_forms(words, ratio=5)


#: The labelled URL table: names of sites that a text corpus leaves out, and of sites that it takes. Each gets a prefix, a
#: domain and a path in turn, so that only the names tell the labels apart.
UNWANTED = (
    "casino poker slots roulette jackpot lottery bets betting bingo wager casino-bonus win-prize big-win pills cheap-pills pharma-discount "
    "viagra cheap-meds diet-pills weight-loss adult adult-cams porn xxx sex-chat escort hot-girls nude spam spam-links link-farm seo-farm "
    "ads adserver ads-network track tracker track-clicks banner popup clicks free-gift free-money free-spins payday loans quick-loans "
    "crypto-bonus replica warez cracks keygen torrents"
).split()
WANTED = (
    "news daily-news journal library museum university school science weather recipes garden travel health city-council parks docs wiki "
    "forum research history music books sport art theatre cinema photos maps trains flights hotel kitchen family parents students teachers "
    "physics biology chemistry mathematics languages grammar dictionary letters poems stories radio television magazine review opinion "
    "economy finance bank insurance law court parliament election village mountain river ocean island forest animals birds flowers farmers "
    "market bakery coffee tea wine cheese bread fishing running cycling football tennis chess puzzles toys crafts sewing furniture "
    "architecture bridges engineering software hardware networks database security robots space planets climate energy water recycling "
    "thornton rensher anderly londhart ashton bethany whithorn erlington oreland handover"
).split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    prefixes, endings, paths = ("", "www.", "blog.", "m."), ("com", "org", "net"), ("en/{}", "de/{}/", "fr/{}.html", "es/{}?page=2", "about", "")
    rows = []
    for blocked, names in ((1, UNWANTED), (0, WANTED)):
        for i, name in enumerate(names):
            path = paths[i % len(paths)].format(100 + 7919 * i % 50000)
            rows.append((f"https://{prefixes[i % len(prefixes)]}{name}.example.{endings[i % len(endings)]}/{path}", blocked))
    return spark.createDataFrame(rows, "url string, blocked int")


RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


@query("op12_url_filter")
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), train_urls(labelled_urls(spark)), RULES)
