"""DuckDB text of the derived input views, to put in front of oracle queries."""

FACE_META = """face_meta as (
  select d.doc_id, concat('src/', cast(d.doc_id as varchar), '.jpg') as file_name,
    case when d.doc_id % 17 = 0 then cast(0 as double)
         else cast(711000 + (d.doc_id * 37) % 25000 as double) + cast(0.5 as double) end as dob,
    cast(1960 + (d.doc_id * 13) % 60 as int) as photo_taken,
    case when l.quality is null then cast('NaN' as double) else cast(l.quality as double) end as gender,
    case when d.doc_id % 11 = 0 then cast('-Infinity' as double)
         else cast((d.doc_id * 7919) % 1000 as double) / cast(200 as double) end as face_score,
    case when d.doc_id % 3 = 0 then cast((d.doc_id * 31) % 1000 as double) / cast(200 as double)
         else cast('NaN' as double) end as second_face_score,
    d.source
  from documents d left join labels l on d.doc_id = l.doc_id)"""

AGED = f"""{FACE_META},
born as (
  select *, date '0001-01-01' + (greatest(cast(trunc(dob) as int) - 366, 1) - 1) as birth from face_meta),
aged as (
  select *, cast(photo_taken - year(birth) - case when month(birth) < 7 then 0 else 1 end as int) as age from born)"""

CLEAN = f"""{AGED},
kept as (
  select * from aged
  where not (face_score < 0.75) and age between 0 and 100 and gender is not null and not isnan(gender))"""

# NaN and infinity, as engines write them alike.
PLAIN = "case when isnan({0}) then null when isinf({0}) then -999 else {0} end as {0}"
SCORES = ", ".join(PLAIN.format(c) for c in ("gender", "face_score", "second_face_score"))

IMAGE_FILES = """image_files as (
  select concat('src/', cast(doc_id as varchar), '.jpg') as path, n_chars as length
  from documents where doc_id % 10 <> 0)"""

DETECTIONS = """detections as (
  select d.doc_id, k.det_idx from documents d cross join (values (0),(1),(2)) k(det_idx)
  where k.det_idx < d.doc_id % 4)"""

LOGITS = """logits as (
  select m.idx, e.vec_id, e.vec_id // 32 as batch_id, e.label as age_label, e.label % 2 as gender_label,
    cast(list_slice(e.embedding, 1 + 10 * m.idx, 10 + 10 * m.idx) as double[]) as age_logits,
    cast(list_slice(e.embedding, 51 + 2 * m.idx, 52 + 2 * m.idx) as double[]) as gender_logits
  from embeddings e cross join (values (0),(1),(2),(3),(4)) m(idx))"""

PROBS = f"""{LOGITS},
exps as (
  select *, list_transform(age_logits, lambda x: exp(x - list_max(age_logits))) as ea,
    list_transform(gender_logits, lambda x: exp(x - list_max(gender_logits))) as eg from logits),
probs as (
  select *, list_transform(ea, lambda x: x / list_sum(ea)) as pa,
    list_transform(eg, lambda x: x / list_sum(eg)) as pg from exps)"""

SCORED = f"""{PROBS},
scored as (
  select idx, vec_id, batch_id, age_label, gender_label,
    ln(list_sum(ea)) + list_max(age_logits) - age_logits[age_label + 1] as age_xent,
    ln(list_sum(eg)) + list_max(gender_logits) - gender_logits[gender_label + 1] as gender_xent,
    list_sum(list_transform(pa, lambda x, i: x * (i - 1))) as pred_age,
    cast(list_position(gender_logits, list_max(gender_logits)) - 1 as int) as pred_gender,
    len(list_filter(gender_logits, lambda x: x > gender_logits[gender_label + 1])) < 1 as gender_hit
  from probs)"""

BATCHES = f"""{SCORED},
penalty as (
  select sum(1e-5 * list_sum(list_transform(embedding, lambda w: cast(w as double) * w)) / 2) as penalty
  from embeddings),
batches as (
  select idx, batch_id, count(*) as n_rows, avg(age_xent) as age_xent, avg(gender_xent) as gender_xent,
    avg(abs(pred_age - age_label)) as age_mae, avg(case when gender_hit then 1.0 else 0.0 end) as gender_acc
  from scored group by idx, batch_id)"""

EXAMPLE = """example as (
  select doc_id, doc_id % 101 as age, doc_id % 2 as gender,
    encode(substr(md5(text), 1, 12)) as image_raw, text,
    concat('src/', cast(doc_id as varchar), '.jpg') as file_name
  from documents)"""
