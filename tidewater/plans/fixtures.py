"""Derived inputs built from the driver tables, each with a Spark builder and
an equivalent DuckDB common-table expression for the oracle.

These replace the reference's own input files (follow lists, SSH logs,
edge lists, embeddings files, sheets, file trees, annotation TSVs), which are
not part of the reference repository. Every fixture is a pure function of
the tables, so its size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import spread
from tidewater.sources.tables import Tables

# --------------------------------------------------------------------------
# K1 follow graph: users are all customers and all suppliers (ids in a range
# of their own); a customer follows the distinct suppliers of its orders.
# Suppliers follow nobody and customers have no followers.
# --------------------------------------------------------------------------

SUPPLIER_USERS = 1_000_000_000_000  # first id of the suppliers


def follow_graph(t: Tables) -> tuple[DataFrame, DataFrame]:
    users = t.customer.select(F.col("c_custkey").alias("user_id")).unionByName(
        t.supplier.select((F.col("s_suppkey") + SUPPLIER_USERS).alias("user_id")))
    edges = (t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
             .select(F.col("o_custkey").alias("user_id"), (F.col("l_suppkey") + SUPPLIER_USERS).alias("followed"))
             .distinct())
    return users, edges


FOLLOW_GRAPH_SQL = f"""
users AS (SELECT c_custkey AS user_id FROM customer UNION ALL SELECT s_suppkey + {SUPPLIER_USERS} FROM supplier),
edges AS (
  SELECT DISTINCT o.o_custkey AS user_id, l.l_suppkey + {SUPPLIER_USERS} AS followed
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey)
"""


# --------------------------------------------------------------------------
# K2 SSH auth log: one syslog line per event.
#   error    → Failed password (IP missing for every 9th event id)
#   signup   → Accepted password
#   click    → Failed password for invalid user <name>
#   view     → message repeated N times: [ Failed password ... ]  (N = 2..4)
#   purchase → noise: disconnect line (no password) or a password line that
#              is neither accepted nor failed
# --------------------------------------------------------------------------

# fixed values: invalid user names used by the synthetic log
INVALID_NAMES = ["admin", "test", "oracle", "support", "guest", "pi", "ubnt", "postgres"]


def auth_log(t: Tables) -> DataFrame:
    e = spread(t.events)
    uid, eid, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    user = F.when(uid % 10 == 0, F.concat(F.lit("svc-"), uid.cast("string"))) \
            .otherwise(F.concat(F.lit("u"), uid.cast("string")))
    bad = F.element_at(F.array(*[F.lit(x) for x in INVALID_NAMES]), (uid % 8 + 1).cast("int"))
    ip = F.when((kind == "error") & (eid % 9 == 0), F.lit("UNKNOWN")).otherwise(
        F.concat_ws(".", F.lit("203"), F.lit("0"), (uid % 6).cast("string"), (eid % 4 + 1).cast("string")))
    port = (eid % 50000 + 1024).cast("string")
    tail = F.concat(F.lit(" from "), ip, F.lit(" port "), port, F.lit(" ssh2"))
    prefix = F.concat(
        F.date_format("ts", "MMM"), F.lit(" "), F.lpad(F.dayofmonth("ts").cast("string"), 2, " "),
        F.lit(" "), F.date_format("ts", "HH:mm:ss"), F.lit(" node"), (uid % 4).cast("string"),
        F.lit(" sshd["), (eid % 9000 + 1000).cast("string"), F.lit("]: "))
    body = (F.when(kind == "error", F.concat(F.lit("Failed password for "), user, tail))
            .when(kind == "signup", F.concat(F.lit("Accepted password for "), user, tail))
            .when(kind == "click", F.concat(F.lit("Failed password for invalid user "), bad, tail))
            .when(kind == "view", F.concat(F.lit("message repeated "), (eid % 3 + 2).cast("string"),
                                           F.lit(" times: [ Failed password for "), user, tail, F.lit("]")))
            .when(eid % 2 == 0, F.concat(F.lit("Received disconnect from "), ip, F.lit(" port "), port,
                                         F.lit(":11: Bye Bye [preauth]")))
            .otherwise(F.concat(F.lit("pam_unix(sshd:auth): password check failed for "), user)))
    return e.select(F.concat(prefix, body).alias("line"))


_NAMES_SQL = "[" + ", ".join(f"'{x}'" for x in INVALID_NAMES) + "]"

# The oracle derives the parsed fields straight from `events`, never from
# the text, so it checks the parse as well as the aggregation.
AUTH_SQL = f"""
auth AS (
  SELECT strftime(ts, '%b') AS month, CAST(day(ts) AS VARCHAR) AS day,
    CASE WHEN event_type = 'click' THEN {_NAMES_SQL}[user_id % 8 + 1]
         WHEN user_id % 10 = 0 THEN 'svc-' || user_id ELSE 'u' || user_id END AS user,
    CASE WHEN event_type = 'error' AND event_id % 9 = 0 THEN NULL
         WHEN event_type = 'purchase' THEN NULL
         ELSE '203.0.' || (user_id % 6) || '.' || (event_id % 4 + 1) END AS ip,
    event_type = 'signup' AS accepted,
    event_type IN ('error', 'click', 'view') AS failed,
    event_type = 'click' AS invalid,
    event_type AS etype,
    CAST(CASE WHEN event_type = 'view' THEN event_id % 3 + 2 ELSE 1 END AS BIGINT) AS weight
  FROM events
  WHERE event_type <> 'purchase' OR event_id % 2 = 1)
"""


# --------------------------------------------------------------------------
# K6 university triples from the TPC-H-ish tables.
#   teachers   ← supplier ⋈ nation ⋈ region   (every third is a senior teacher)
#   programmes ← nation ⋈ region
#   courses    ← part                         (programme = partkey mod 25)
#   instances  ← lineitem (one per line; year and quarter of shipdate)
#   hours      ← lineitem (teacher = suppkey, hours = 3 × quantity)
#   students   ← customer; registrations ← orders (instance = CI-<priority>)
# --------------------------------------------------------------------------


def _instance_id():
    return F.concat_ws("-", F.lit("I"), F.col("offer.l_partkey").cast("string"), F.col("offer.y").cast("string"), F.col("offer.q").cast("string"))


def _offered(t: Tables) -> DataFrame:
    # the offer's part and quarter are one key, which joins its nulls, too
    offer = F.struct("l_partkey", F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q"))
    return t.lineitem.select(offer.alias("offer"), "l_suppkey", "l_quantity")


def _plannings(li: DataFrame) -> DataFrame:
    """(offer, plan_students, senior_hours, assist_hours)"""
    hours = F.col("l_quantity") * 3
    senior = F.col("l_suppkey") % 3 == 0
    return li.groupBy("offer").agg(
        F.count(F.lit(1)).alias("plan_students"), F.sum(F.when(senior, hours).otherwise(0.0)).cast("float").alias("senior_hours"),
        F.sum(F.when(senior, 0.0).otherwise(hours)).cast("float").alias("assist_hours"))


def course_plannings(t: Tables) -> DataFrame:
    """(ind, plan_students, senior_hours, assist_hours): a row for each course
    instance; senior teachers' hours and the others'."""
    return _plannings(_offered(t)).select(_instance_id().alias("ind"), "plan_students", "senior_hours", "assist_hours")


def university_triples(t: Tables) -> DataFrame:
    from tidewater.operators.triples import SheetRule, attach_sheet, to_triples, union_triples

    senior = F.col("s_suppkey") % 3 == 0
    teachers = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
                .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
                .select(F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("ind"),
                        F.when(senior, "SeniorTeacher").otherwise("Teacher").alias("typ"),
                        F.when(senior, F.concat(F.lit("Teacher "), "s_name"))
                         .otherwise(F.concat(F.lit("TA "), "s_name")).alias("name"),
                        F.col("s_suppkey").cast("string").alias("tid"), "n_name", "r_name"))
    programmes = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
                  .select(F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("ind"),
                          "n_name", "r_name",
                          F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("director")))
    courses = t.part.select(
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("ind"),
        F.col("p_partkey").cast("string").alias("code"), "p_name", "p_type", "p_brand",
        F.col("p_size").cast("float").alias("credits"),
        F.concat(F.lit("P"), (F.col("p_partkey") % 25).cast("string")).alias("prog"))
    # a course instance is a part offered in one quarter of one year; the
    # teaching load is summed per (instance, teacher). One exchange of the lines
    # by the offer serves all three aggregates and the attached sheet
    li, inst_id = _offered(t).repartition("offer"), _instance_id()
    instances = li.groupBy("offer").agg(F.min("l_suppkey").alias("examiner"))
    # a second sheet (course plannings) keyed by the instance's offer
    instances = attach_sheet(instances, _plannings(li), "offer").select(
        inst_id.alias("ind"), F.col("offer.l_partkey").cast("string").alias("code"),
        F.concat(F.col("offer.y").cast("string"), F.lit("-"), (F.col("offer.y") + 1).cast("string")).alias("ay"),
        F.col("offer.q").cast("double").cast("string").alias("period"),
        F.col("examiner").cast("string").alias("examiner"), "plan_students", "senior_hours", "assist_hours")
    hours = li.groupBy("offer", "l_suppkey").agg(
        (F.sum("l_quantity") * 3).cast("float").alias("hrs")).select(
        F.concat_ws("-", F.lit("H"), F.col("offer.l_partkey").cast("string"), F.col("offer.y").cast("string"),
                    F.col("offer.q").cast("string"), F.col("l_suppkey").cast("string")).alias("ind"),
        inst_id.alias("inst"), F.col("l_suppkey").cast("string").alias("teacher"), "hrs")
    students = t.customer.select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("ind"),
        F.col("c_custkey").cast("string").alias("sid"), "c_name",
        F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("prog"),
        (F.col("c_acctbal") > 5000).alias("grad"), (1990 + F.col("c_custkey") % 10).cast("int").alias("start"))
    regs = t.orders.select(
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("ind"),
        F.concat(F.lit("CI-"), F.substring("o_orderpriority", 1, 1)).alias("inst"),
        F.col("o_custkey").cast("string").alias("student"), "o_orderstatus",
        F.substring_index("o_orderpriority", "-", -1).alias("grade"))
    # courses that programmes offer: every course in its programme's plan
    offers = t.part.select(
        F.concat(F.lit("PI"), F.col("p_partkey").cast("string")).alias("ind"),
        F.concat(F.lit("P"), (F.col("p_partkey") % 25).cast("string")).alias("prog"),
        (1 + F.col("p_size") % 3).cast("int").alias("study_year"),
        F.concat_ws("-", (1992 + F.col("p_partkey") % 7).cast("string"), (1993 + F.col("p_partkey") % 7).cast("string")).alias("ay"),
        F.col("p_partkey").cast("string").alias("code"), F.substring_index("p_type", " ", -1).alias("kind"))
    # fixed values: the type and predicate names of the sheets, in their order
    parts = [
        to_triples(teachers, SheetRule("ind", F.col("typ"), {
            "teacherName": ("name", "string"), "teacherID": ("tid", "string"),
            "tDepartment": ("n_name", "string"), "tDivision": ("r_name", "string")})),
        to_triples(programmes, SheetRule("ind", "Program", {
            "programName": ("n_name", "string"), "programCode": ("ind", "string"),
            "pDepartment": ("r_name", "string"), "director": ("director", "string")})),
        to_triples(courses, SheetRule("ind", "Course", {
            "courseCode": ("code", "string"), "courseName": ("p_name", "string"),
            "credits": ("credits", "float"), "courseLevel": ("p_type", "string"),
            "cDivision": ("p_brand", "string"), "cProgram": ("prog", "string")})),
        to_triples(instances, SheetRule("ind", "CourseInstance", {
            "instanceID": ("ind", "string"), "ciCourseCode": ("code", "string"),
            "planNumStudents": ("plan_students", "integer"),
            "seniorHours": ("senior_hours", "float"), "assistHours": ("assist_hours", "float"),
            "cAcademicYear": ("ay", "string"), "studyPeriod": ("period", "string"),
            "examiner": ("examiner", "string")})),
        to_triples(hours, SheetRule("ind", "TeachingAssignment", {
            "hoursCourseInstance": ("inst", "string"), "hoursTeacher": ("teacher", "string"),
            "rHours": ("hrs", "float"), "aHours": ("hrs", "float")})),
        to_triples(students, SheetRule("ind", "Students", {
            "studentID": ("sid", "string"), "studentName": ("c_name", "string"),
            "sProgram": ("prog", "string"), "startYear": ("start", "integer"), "graduated": ("grad", "boolean")})),
        to_triples(regs, SheetRule("ind", "Registrations", {
            "registrationsCourseInstance": ("inst", "string"),
            "registrationsStudents": ("student", "string"),
            "registrationStatus": ("o_orderstatus", "string"), "grade": ("grade", "string")})),
        to_triples(offers, SheetRule("ind", "ProgramInstance", {
            "piProgramCode": ("prog", "string"), "piStudyYear": ("study_year", "integer"),
            "piAcademicYear": ("ay", "string"), "piCourse": ("code", "string"),
            "piCourseType": ("kind", "string")})),
    ]
    return union_triples(parts)


# Relational form of the same data for the oracle (no triples involved).
UNIVERSITY_SQL = """
teachers AS (
  SELECT 'T' || s_suppkey AS ind,
         CASE WHEN s_suppkey % 3 = 0 THEN 'Teacher ' || s_name ELSE 'TA ' || s_name END AS name,
         CAST(s_suppkey AS VARCHAR) AS tid, n_name, r_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
instances AS (
  SELECT DISTINCT 'I-' || l_partkey || '-' || year(l_shipdate) || '-' || quarter(l_shipdate) AS ind,
         CAST(l_partkey AS VARCHAR) AS code,
         year(l_shipdate) || '-' || (year(l_shipdate) + 1) AS ay,
         CAST(CAST(quarter(l_shipdate) AS DOUBLE) AS VARCHAR) AS period
  FROM lineitem),
hours AS (
  SELECT 'I-' || l_partkey || '-' || year(l_shipdate) || '-' || quarter(l_shipdate) AS inst,
         CAST(l_suppkey AS VARCHAR) AS teacher, CAST(sum(l_quantity) * 3 AS FLOAT) AS hrs
  FROM lineitem GROUP BY l_partkey, year(l_shipdate), quarter(l_shipdate), l_suppkey)
"""


# --------------------------------------------------------------------------
# K7 file corpus: each document is a file under /corpus/<source>/ whose
# extension depends on its language (en → .c, fr → .h, de → .H, es → .txt);
# each page is /web/<page_id>.html.
# --------------------------------------------------------------------------


def corpus_files(t: Tables) -> DataFrame:
    lang = F.col("lang")
    ext = (F.when(lang == "en", "c").when(lang == "fr", "h").when(lang == "de", "H").otherwise("txt"))
    docs = spread(t.documents).select(
        F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/doc"), F.col("doc_id").cast("string"),
                 F.lit("."), ext).alias("path"), ext.alias("ext"), F.col("text").alias("content"))
    pages = spread(t.pages).select(
        F.concat(F.lit("/web/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"),
        F.lit("html").alias("ext"), F.col("html").alias("content"))
    return docs.unionByName(pages)


def digest_manifest(t: Tables) -> DataFrame:
    """Stored digests: exact for documents, of the right-trimmed html for
    pages (so trailing-space pages show up as mismatches)."""
    files = corpus_files(t)
    c = F.when(F.col("ext") == "html", F.rtrim("content")).otherwise(F.col("content"))
    return files.select("path", F.sha1(c.cast("binary")).alias("sha1"))


CORPUS_SQL = """
files AS (
  SELECT '/corpus/' || source || '/doc' || doc_id || '.' || ext AS path, ext, text AS content
  FROM (SELECT *, CASE lang WHEN 'en' THEN 'c' WHEN 'fr' THEN 'h' WHEN 'de' THEN 'H' ELSE 'txt' END AS ext
        FROM documents)
  UNION ALL
  SELECT '/web/' || page_id || '.html', 'html', html FROM pages),
file_lines AS (SELECT path, unnest(string_split(content, chr(10))) AS line FROM files)
"""


# --------------------------------------------------------------------------
# K8 annotator votes: three votes per labelled document — quality, toxic and
# (doc_id mod 3) − 1 — slash-joined; every tenth document has a lone "-1".
# --------------------------------------------------------------------------


def annotated(t: Tables) -> DataFrame:
    lab = t.labels
    votes = F.when(F.col("doc_id") % 10 == 0, F.lit("-1")).otherwise(F.concat_ws(
        "/", F.col("quality").cast("string"), F.col("toxic").cast("string"),
        (F.col("doc_id") % 3 - 1).cast("string")))
    return lab.join(t.documents.select("doc_id", "text"), "doc_id").select("doc_id", votes.alias("votes"), "text")


ANNOT_SQL = """
votes AS (
  SELECT l.doc_id,
         CASE WHEN l.doc_id % 10 = 0 THEN '-1' ELSE l.quality || '/' || l.toxic || '/' || (l.doc_id % 3 - 1) END AS votes,
         d.text
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
tallies AS (
  SELECT doc_id, votes, text,
         (CASE WHEN doc_id % 10 = 0 THEN 0 ELSE (quality = 0)::INT + (toxic = 0)::INT + (doc_id % 3 = 1)::INT END) AS n0,
         (CASE WHEN doc_id % 10 = 0 THEN 0 ELSE (quality = 1)::INT + (toxic = 1)::INT + (doc_id % 3 = 2)::INT END) AS n1
  FROM labels JOIN (SELECT doc_id AS d_id, text FROM documents) ON doc_id = d_id
       JOIN (SELECT doc_id AS v_id, votes FROM votes) ON doc_id = v_id),
merged AS (
  SELECT doc_id, text, votes, n0, n1,
         CAST(CASE WHEN n0 + n1 = 0 THEN -1 WHEN n1 > n0 THEN 1 WHEN n0 > n1 THEN 0 ELSE -1 END AS INTEGER) AS label
  FROM tallies)
"""


# --------------------------------------------------------------------------
# K4 vectors: the embeddings table with a word per row ("w<vec_id>") and
# double-precision vectors. K5 geo: customers are the points, suppliers the
# queries, with coordinates spread over the globe by integer arithmetic on
# the keys.
# --------------------------------------------------------------------------


def embedding_rows(t: Tables) -> DataFrame:
    return t.embeddings.select(
        F.col("vec_id").alias("id"), F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vec"), "label")


EMB_SQL = """
e AS (SELECT vec_id, label, 'w' || vec_id AS word, embedding::DOUBLE[] AS v FROM embeddings),
c AS (SELECT label, list(m ORDER BY i) AS cv FROM (
        SELECT label, i, avg(x) AS m FROM (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e)
        GROUP BY label, i) GROUP BY label),
nn AS (SELECT * FROM (
        SELECT c.label AS q_id, e.vec_id AS id, list_distance(e.v, c.cv) AS d,
               row_number() OVER (PARTITION BY c.label ORDER BY list_distance(e.v, c.cv), e.vec_id) AS rank
        FROM e, c) WHERE rank = 1),
u AS (SELECT vec_id, word, list_transform(v, lambda x: x / nrm) AS u, v FROM (
        SELECT vec_id, word, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm FROM e) WHERE nrm > 0),
medoids AS (SELECT nn.q_id AS label, u.vec_id AS q_id, u.u AS qu, u.v AS qv FROM nn JOIN u ON u.word = 'w' || nn.id)
"""


def _deg(key: Column, mul: int, mod: int, off: float) -> Column:
    return ((key * mul) % mod).cast("double") / 100.0 - off


def geo_points(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(k.alias("id"), F.col("c_name").alias("name"),
                             _deg(k, 7919, 17001, 85.0).alias("lat"), _deg(k, 104729, 36001, 180.0).alias("lon"))


def geo_queries(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(k.alias("q_id"), _deg(k, 4001, 17001, 85.0).alias("lat"),
                             _deg(k, 7727, 36001, 180.0).alias("lon"))


GEO_SQL = """
pts AS (SELECT c_custkey AS id, c_name AS name, ((c_custkey * 7919) % 17001) / 100.0 - 85.0 AS lat,
               ((c_custkey * 104729) % 36001) / 100.0 - 180.0 AS lon FROM customer),
qs AS (SELECT s_suppkey AS q_id, ((s_suppkey * 4001) % 17001) / 100.0 - 85.0 AS lat,
              ((s_suppkey * 7727) % 36001) / 100.0 - 180.0 AS lon FROM supplier)
"""


# --------------------------------------------------------------------------
# K9 predictions for the evaluation tables: a fixed rule classifier of
# l_returnflag from the discount, so every metric is checkable in SQL.
# --------------------------------------------------------------------------


def rule_predictions(t: Tables) -> DataFrame:
    disc = F.col("l_discount")
    pred = F.when(disc < 0.035, "A").when(disc < 0.07, "N").otherwise("R")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             F.col("l_returnflag").alias("label"), pred.alias("prediction"),
                             "l_discount", "l_quantity", "l_extendedprice", "l_tax")


PRED_SQL = """
pred AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS label,
                CASE WHEN l_discount < 0.035 THEN 'A' WHEN l_discount < 0.07 THEN 'N' ELSE 'R' END AS prediction,
                l_discount, l_quantity, l_extendedprice, l_tax FROM lineitem)
"""


def hash_sql(id_expr: str, seed: int) -> str:
    return f"('0x' || substr(md5({id_expr} || ':{seed}'), 1, 8))::BIGINT"
