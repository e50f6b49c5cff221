"""K6 graph-pattern queries (the reference's SPARQL questions) over triples
built from the driver tables; oracles use the relational tables directly."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import functions as F

from tidewater.operators import triples as TR
from tidewater.plans.fixtures import UNIVERSITY_SQL, course_plannings, university_triples
from tidewater.plans.registry import query
from tidewater.session import input_signature, materialize, shared_path
from tidewater.sources.readers import number_lines
from tidewater.sources.tables import Tables

_W = "WITH " + UNIVERSITY_SQL

# fixed values: the constants of the pattern queries
DIVISION, YEAR_2, PERIOD_2 = "Brand#3", "1996-1997", "2.0"
COURSE_3, YEAR_3, PERIOD_3, MIN_HOURS = "7", "1998-1999", "1.0", 120
INST_A, INST_B = "CI-1", "CI-2"


def _triples(spark, d):
    # written once per session, in the order of the sheets: no shuffle and no sort
    return materialize(university_triples(Tables(spark, d)), f"triples-{_tag(d)}")


def _tag(d):
    return hashlib.md5(d.encode()).hexdigest()[:10]


def _store(spark, d, *patterns):
    """The triples and the counts of the patterns' predicates, each written once."""
    source, predicates = university_triples(Tables(spark, d)), sorted({p for _, p, _ in patterns})
    now = input_signature(source)
    triples = materialize(source, f"triples-{_tag(d)}", signature=now)
    return TR.build_store(triples, lambda df, name: materialize(df, f"triples-{name}-{_tag('|'.join(predicates))}-{_tag(d)}", signature=now), predicates)


def _match(spark, d, patterns, **kw):
    return TR.match_stars(_store(spark, d, *patterns), patterns, **kw)


@query("triples_per_predicate", """
WITH ni AS (SELECT count(DISTINCT (l_partkey, year(l_shipdate), quarter(l_shipdate))) AS n FROM lineitem),
nh AS (SELECT count(DISTINCT (l_partkey, year(l_shipdate), quarter(l_shipdate), l_suppkey)) AS n FROM lineitem),
c AS (
  SELECT 'rdf:type' AS p, (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation)
       + (SELECT count(*) FROM part) + (SELECT n FROM ni) + (SELECT n FROM nh)
       + (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM part) AS n
  UNION ALL SELECT unnest(['teacherName','teacherID','tDepartment','tDivision']), (SELECT count(*) FROM supplier)
  UNION ALL SELECT unnest(['programName','programCode','pDepartment','director']), (SELECT count(*) FROM nation)
  UNION ALL SELECT unnest(['courseCode','courseName','credits','courseLevel','cDivision','cProgram']), (SELECT count(*) FROM part)
  UNION ALL SELECT unnest(['instanceID','ciCourseCode','cAcademicYear','studyPeriod','examiner','planNumStudents','seniorHours','assistHours']), (SELECT n FROM ni)
  UNION ALL SELECT unnest(['hoursCourseInstance','hoursTeacher','rHours','aHours']), (SELECT n FROM nh)
  UNION ALL SELECT unnest(['studentID','studentName','sProgram','graduated','startYear']), (SELECT count(*) FROM customer)
  UNION ALL SELECT unnest(['registrationsCourseInstance','registrationsStudents','registrationStatus','grade']), (SELECT count(*) FROM orders)
  UNION ALL SELECT unnest(['piProgramCode','piStudyYear','piAcademicYear','piCourse','piCourseType']), (SELECT count(*) FROM part))
SELECT p, CAST(n AS BIGINT) AS n FROM c
""")
def triples_per_predicate(spark, d):
    return _triples(spark, d).groupBy("p").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("sparql_teachers", _W + "SELECT ind AS ta, name AS tn, n_name AS tp, r_name AS td FROM teachers")
def sparql_teachers(spark, d):
    return _match(spark, d, [
        ("?ta", "teacherName", "?tn"), ("?ta", "tDepartment", "?tp"), ("?ta", "tDivision", "?td")])


@query("sparql_programmes", """
SELECT 'P' || n_nationkey AS prg, n_name AS pn, 'T' || n_nationkey AS pd, r_name AS ptd
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def sparql_programmes(spark, d):
    return _match(spark, d, [
        ("?prg", "programName", "?pn"), ("?prg", "director", "?pd"), ("?prg", "pDepartment", "?ptd")])


@query("sparql_ta_in_division", _W + f"""
SELECT DISTINCT t.ind AS taURI, t.name AS teacherName
FROM teachers t JOIN hours h ON h.teacher = t.tid JOIN instances i ON i.ind = h.inst
JOIN part p ON CAST(p.p_partkey AS VARCHAR) = i.code
WHERE i.ay = '{YEAR_2}' AND i.period = '{PERIOD_2}' AND p.p_brand = '{DIVISION}'
  AND regexp_matches(t.name, '(?i)TA.*')
""")
def sparql_ta_in_division(spark, d):
    return _match(spark, d, [
        ("?taURI", "teacherID", "?teacherID"), ("?taURI", "teacherName", "?teacherName"),
        ("?h", "hoursTeacher", "?teacherID"), ("?h", "hoursCourseInstance", "?ci"),
        ("?c", "instanceID", "?ci"), ("?c", "ciCourseCode", "?cc"),
        ("?c", "cAcademicYear", YEAR_2), ("?c", "studyPeriod", PERIOD_2),
        ("?course", "courseCode", "?cc"), ("?course", "cDivision", DIVISION)],
        filters=[TR.regex_filter("teacherName", "TA.*", "i")],
        select=["taURI", "teacherName"], distinct=True)


@query("sparql_hours_over", _W + f"""
SELECT DISTINCT t.ind AS taURI, t.name AS teacherName
FROM teachers t JOIN hours h ON h.teacher = t.tid JOIN instances i ON i.ind = h.inst
WHERE i.ay = '{YEAR_3}' AND i.period = '{PERIOD_3}' AND i.code = '{COURSE_3}' AND h.hrs > {MIN_HOURS}
""")
def sparql_hours_over(spark, d):
    return _match(spark, d, [
        ("?taURI", "teacherID", "?teacherID"), ("?taURI", "teacherName", "?teacherName"),
        ("?h", "hoursTeacher", "?teacherID"), ("?h", "hoursCourseInstance", "?ci"),
        ("?h", "aHours", "?aHours"),
        ("?c", "instanceID", "?ci"), ("?c", "ciCourseCode", "?cc"),
        ("?c", "cAcademicYear", YEAR_3), ("?c", "studyPeriod", PERIOD_3), ("?c", "ciCourseCode", COURSE_3)],
        filters=[F.col("aHours").cast("double") > MIN_HOURS],
        select=["taURI", "teacherName"], distinct=True)


@query("sparql_registered_not_in", f"""
SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS studentID
FROM customer JOIN orders ON o_custkey = c_custkey
WHERE 'CI-' || substr(o_orderpriority, 1, 1) = '{INST_A}'
  AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE 'CI-' || substr(o_orderpriority, 1, 1) = '{INST_B}')
""")
def sparql_registered_not_in(spark, d):
    in_a = [("?studentURI", "studentID", "?studentID"),
            ("?r", "registrationsStudents", "?studentID"), ("?r", "registrationsCourseInstance", INST_A)]
    in_b = [("?r", "registrationsStudents", "?studentID"), ("?r", "registrationsCourseInstance", INST_B)]
    tr = _store(spark, d, *in_a, *in_b)
    reg_a = TR.match_stars(tr, in_a, select=["studentID"], distinct=True)
    reg_b = TR.match_stars(tr, in_b, select=["studentID"])
    return TR.not_exists(reg_a, reg_b, ["studentID"])


@query("sparql_courses_per_programme", """
SELECT 'P' || (p_partkey % 25) AS cprog, CAST(count(*) AS BIGINT) AS owned_courses
FROM part GROUP BY 1
""")
def sparql_courses_per_programme(spark, d):
    b = _match(spark, d, [("?c", "courseCode", "?cc"), ("?c", "cProgram", "?cprog")])
    return TR.group_count(b, "cprog", "cc", "owned_courses").orderBy(F.desc("owned_courses"))


@query("sparql_count_senior_teachers", _W + """
SELECT CAST(count(*) AS BIGINT) AS teacher_count FROM teachers WHERE regexp_matches(name, '(?i)Teac.*')
""")
def sparql_count_senior_teachers(spark, d):
    b = _match(spark, d, [("?t", "teacherID", "?id"), ("?t", "teacherName", "?n")],
                     filters=[TR.regex_filter("n", "Teac.*", "i")])
    return TR.count_bindings(b, "teacher_count")


@query("sparql_count_people", _W + """
SELECT CAST((SELECT count(*) FROM teachers WHERE regexp_matches(name, '(?i)Teac.*'))
          + (SELECT count(*) FROM customer) AS BIGINT) AS people_count
""")
def sparql_count_people(spark, d):
    seniors, enrolled = [("?t", "teacherID", "?id"), ("?t", "teacherName", "?n")], [("?s", "studentID", "?id")]
    tr = _store(spark, d, *seniors, *enrolled)
    teachers = TR.match_stars(tr, seniors, filters=[TR.regex_filter("n", "Teac.*", "i")], select=["id"])
    students = TR.match_stars(tr, enrolled, select=["id"])
    return TR.count_bindings(teachers.unionByName(students), "people_count")


MIN_PLANNED = 3


@query("sparql_planned_instances", f"""
SELECT 'I-' || l_partkey || '-' || year(l_shipdate) || '-' || quarter(l_shipdate) AS ci,
       CAST(count(*) AS VARCHAR) AS n
FROM lineitem GROUP BY l_partkey, year(l_shipdate), quarter(l_shipdate) HAVING count(*) >= {MIN_PLANNED}
""")
def sparql_planned_instances(spark, d):
    """Instances whose planned student count (a fact from the second sheet,
    J14) is at least MIN_PLANNED; the typed literal is cast for the filter."""
    return _match(spark, d, [("?c", "instanceID", "?ci"), ("?c", "planNumStudents", "?n")],
                        filters=[F.col("n").cast("int") >= MIN_PLANNED], select=["ci", "n"])


@query("sheet_attach_by_position", """
SELECT 'I-' || l_partkey || '-' || year(l_shipdate) || '-' || quarter(l_shipdate) AS ind, CAST(l_partkey AS VARCHAR) AS code, CAST(count(*) AS INTEGER) AS plan_students,
       CAST(sum(CASE WHEN l_suppkey % 3 = 0 THEN l_quantity * 3 ELSE 0 END) AS DOUBLE) AS senior_hours, CAST(sum(CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_quantity * 3 END) AS DOUBLE) AS assist_hours
FROM lineitem GROUP BY l_partkey, year(l_shipdate), quarter(l_shipdate)
""")
def sheet_attach_by_position(spark, d):
    """Two sheets as text, in the order of the instances and in different
    numbers of files; facts of the second go to the first by their line."""
    plan = course_plannings(Tables(spark, d))
    folder = shared_path(spark, f"sheets/{uuid.uuid4().hex}")
    first = plan.select("ind", F.concat_ws("\t", "ind", F.split("ind", "-")[1]).alias("value"))
    second = plan.select("ind", F.concat_ws("\t", *[F.col(c).cast("string") for c in ("plan_students", "senior_hours", "assist_hours")]).alias("value"))
    # a file is what one task sorts: their number follows the session's partitions
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for df, name, files in ((first, "instances", 5 + files), (second, "plannings", 3 + files)):
        df.repartitionByRange(files, "ind").sortWithinPartitions("ind").select("value").write.text(f"{folder}/{name}")
    sheets = [number_lines(spark, f"{folder}/{name}").select("line_no", F.split("value", "\t").alias("f")) for name in ("instances", "plannings")]
    a = sheets[0].select("line_no", F.col("f")[0].alias("ind"), F.col("f")[1].alias("code"))
    b = sheets[1].select("line_no", F.col("f")[0].cast("int").alias("plan_students"), F.col("f")[1].cast("double").alias("senior_hours"), F.col("f")[2].cast("double").alias("assist_hours"))
    return TR.attach_by_position(a, b).drop("line_no")
