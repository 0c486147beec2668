"""Queries on labels, names and joining snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions.text import LABEL_FIXES, UNREADABLE, label_name, label_tag, name_key, normal_label
from podium.operators import clean, early, publish
from podium.plans import sqltext as q
from podium.plans.boards import BOARD_SQL, MANIFEST_SQL, board, manifest
from podium.session import durable, table


def _core(column: str):
    return F.translate(F.lower(F.regexp_replace(column, r"[^\p{L}\p{N}]", "")), "ς", "σ")


_CORE = r"translate(lower(regexp_replace({}, '[^\p{L}\p{N}]', '', 'g')), 'ς', 'σ')"


def parse_labels(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "rankings").where("alliance is not null")
    return rows.select("row_id", label_tag(F.col("alliance")).alias("tag"), label_name(F.col("alliance")).alias("name"))


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` in which every seventh label has a server at its end and every eleventh has lost its brackets."""
    bare = F.when(F.col("rank") % 11 == 0, F.translate("alliance", "[]", "")).otherwise(F.col("alliance"))
    return rows.withColumn("alliance", F.when(F.col("rank") % 7 == 0, F.concat(bare, F.lit(" S1001"))).otherwise(bare))


def _fixes(s: SparkSession, d: str) -> DataFrame:
    """The labels known to be misread, and those of the registry without brackets."""
    entries = table(s, d, "alliance_registry").select(F.concat_ws(" ", "alliance_tag", "alliance_name").alias("before"), F.col("alliance").alias("after"))
    return entries.unionByName(s.createDataFrame(list(LABEL_FIXES.items()), "before string, after string"))


def _registry_labels(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "alliance_registry").select(normal_label(F.col("alliance")).alias("label"))


def clean_players(s: SparkSession, d: str) -> DataFrame:
    return clean.clean_players(_marked(board(s, d)), "1000", _fixes(s, d), _registry_labels(s, d)).select("row_id", "alliance", "alliance_tag", "alliance_name", "server")


def lookalike_consolidation(s: SparkSession, d: str) -> DataFrame:
    return clean.consolidate_labels(board(s, d), ["event_id"])


def known_index(s: SparkSession, d: str) -> DataFrame:
    """Known players by a core of small letters and digits, of any script."""
    return clean.known_names(board(s, d).withColumn("pos", F.col("row_id")), key=_core("commander"))


def known_names(s: SparkSession, d: str) -> DataFrame:
    return clean.known_names(board(s, d).withColumn("pos", F.col("row_id")))


def known_labels(s: SparkSession, d: str) -> DataFrame:
    return clean.known_labels(board(s, d))


def label_repairs(s: SparkSession, d: str) -> DataFrame:
    """Repairs of the labels of every event by those of the registry; labels to review stand side by side."""
    repairs = clean.label_repairs(board(s, d), _registry_labels(s, d), group=["event_id"])
    return repairs.withColumn("reviews", F.array_join("reviews", " | "))


def _known(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The registry of spellings as known names with their most seen form, and the labels they were seen with."""
    known = table(s, d, "known_names").where("kind = 'commander'").select("server", name_key(F.col("commander")).alias("name_key"), "commander", "alliance", "n_seen").where("name_key <> ''")
    best = known.groupBy("server", "name_key").agg(F.min(F.struct((-F.col("n_seen")).alias("m"), F.col("commander").alias("v"))).alias("b")).select("server", "name_key", F.col("b.v").alias("commander"))
    return best, known.select("server", "name_key", "alliance").where("alliance is not null").distinct()


def fuzzy_candidates(s: SparkSession, d: str) -> DataFrame:
    """Names of each event's board one edit, in look-alike keys, from a known one of the same server and alliance."""
    return clean.name_candidates(board(s, d), *_known(s, d), group=["event_id"])


def _forms(s: SparkSession, d: str) -> DataFrame:
    """Overrides that the registry of spellings gives: small letters to the known form."""
    forms = table(s, d, "known_names").where("kind = 'commander'").groupBy("server", F.lower("commander").alias("observed")).agg(F.max("commander").alias("canonical"))
    return forms


def _batch(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return clean.clean_batch(_marked(board(s, d)), "1000", _registry_labels(s, d), *_known(s, d), corrections=_fixes(s, d), overrides=_forms(s, d), group=["event_id"])


def cleaning_batch(s: SparkSession, d: str) -> DataFrame:
    """The rows of every event after all steps of cleaning."""
    return _batch(s, d)[0].select("row_id", "commander", "alliance", "alliance_tag", "alliance_name", "server")


def cleaning_changes(s: SparkSession, d: str) -> DataFrame:
    """What the repairs and overrides of the cleaning changed."""
    return _batch(s, d)[1]


def cleaning_reviews(s: SparkSession, d: str) -> DataFrame:
    """What the cleaning leaves for a person to decide."""
    return _batch(s, d)[2]


def name_candidates(s: SparkSession, d: str) -> DataFrame:
    """The same for names of every event against all earlier events."""
    return clean.running_candidates(board(s, d).withColumn("pos", F.col("row_id")))


def override_join(s: SparkSession, d: str) -> DataFrame:
    """Board names with the overrides that the registry of spellings gives."""
    return clean.name_overrides(board(s, d), _forms(s, d)).where("overridden").select("row_id", "server", "commander")


def change_log(s: SparkSession, d: str) -> DataFrame:
    """Fields that a normal form of the label changes."""
    rows = board(s, d).select("row_id", "alliance", "alliance_name")
    return clean.changes_of(rows, rows.withColumn("alliance", normal_label(F.col("alliance"))).withColumn("alliance_name", label_name(F.col("alliance"))), ["row_id"], ["alliance", "alliance_name"])


def _snapshots(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The first incremental scan of each event as the early list, the final as the later one."""
    rows = table(s, d, "rankings").where("scan_kind = 'incremental'").select("event_id", "scan_id", "rank", "commander", "alliance", "server", "points", "row_id")
    first = rows.groupBy("event_id").agg(F.min("scan_id").alias("scan_id"))
    once = rows.join(first, ["event_id", "scan_id"], "left_semi").groupBy("event_id", "rank").agg(F.min_by(F.struct("commander", "alliance", "server", "points"), "row_id").alias("r"))
    return durable(once.select("event_id", "rank", "r.*")), durable(board(s, d).select("event_id", "pos", "rank", "commander", "alliance", "server", "points"))


def early_match(s: SparkSession, d: str) -> DataFrame:
    a, b = _snapshots(s, d)
    return early.match_early(a, b, home="1001")


def _exact(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of early and later rows by name and server, the first of each."""
    left = a.where("commander <> ''").groupBy("event_id", "commander", "server").agg(F.min("rank").cast("int").alias("early_rank"))
    right = b.where("commander <> ''").groupBy("event_id", "commander", "server").agg(F.min("pos").alias("later_pos"))
    return left.join(right, ["event_id", "commander", "server"]).select("event_id", "early_rank", "later_pos")


def clean_prefix(s: SparkSession, d: str) -> DataFrame:
    a, b = _snapshots(s, d)
    return early.clean_cutoff(a, b, _exact(a, b))


def prefix_merge_renumber(s: SparkSession, d: str) -> DataFrame:
    """Early lists merged up to the rank before the first without a partner."""
    a, b = _snapshots(s, d)
    pairs = _exact(a, b)
    per = Window.partitionBy("event_id").orderBy("rank")
    lined = a.join(pairs.withColumnRenamed("early_rank", "rank"), ["event_id", "rank"], "left").withColumn("n", F.row_number().over(per))
    broken = F.min(F.when((F.col("rank") != F.col("n")) | F.col("later_pos").isNull() | F.col("points").isNull(), F.col("n") - 1))
    cut = lined.groupBy("event_id").agg(F.coalesce(broken, F.max("n")).alias("cutoff"))
    return early.merge_early(a, b, pairs, cut)


def _published():
    """A place for each publication, by time."""
    return F.expr("unix_micros(published_at) * 1000 + total_points % 1000")


def latest_wins_dedup(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "war_manifest").select("event_id", "title", "total_players", "total_points", _published().alias("pos"))
    return publish.latest_wins(rows, "event_id")


def upsert_merge(s: SparkSession, d: str) -> DataFrame:
    """The registry of first publications with the last ones put in; odd events are new to it."""
    rows = table(s, d, "war_manifest").select("event_id", "title", "total_points", _published().alias("pos"))
    old = publish.latest_wins(rows.where("total_points % 2 = 0"), "event_id")
    return publish.upsert(old, rows, "event_id")


def latest_pointer(s: SparkSession, d: str) -> DataFrame:
    return publish.is_latest(manifest(s, d)).select("event_id", "event_date", "is_latest")


def scan_index(s: SparkSession, d: str) -> DataFrame:
    return publish.scan_index(table(s, d, "rankings"))


def _tagged(s: SparkSession, d: str) -> DataFrame:
    from podium.operators.rollup import alliance_standings

    return alliance_standings(board(s, d)).withColumn("tag", label_tag(F.col("alliance")))


def threshold_allowlist(s: SparkSession, d: str) -> DataFrame:
    return publish.allow_list(_tagged(s, d), "1001", 1_000_000)


def allowlist_diff(s: SparkSession, d: str) -> DataFrame:
    """From the tags of weaker alliances to those of strong ones."""
    standings = _tagged(s, d)
    return publish.list_difference(publish.allow_list(standings, "1001", 1_000_000), publish.allow_list(standings.where("rank % 3 <> 0"), "1001", 200_000))


def threshold_choice(s: SparkSession, d: str) -> DataFrame:
    rows = manifest(s, d)
    return rows.select("event_id", publish.threshold(F.col("unique_alliances") - 175.0, F.col("total_players") - 1130.0).alias("threshold"))


def content_hash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", publish.content_version(F.col("text")).alias("version"))


QUERIES = {
    f.__name__: f
    for f in (
        parse_labels, clean_players, lookalike_consolidation, known_index, known_names, known_labels, label_repairs, fuzzy_candidates, name_candidates, cleaning_batch, cleaning_changes, cleaning_reviews, override_join, change_log, early_match, clean_prefix,
        prefix_merge_renumber, latest_wins_dedup, upsert_merge, latest_pointer, scan_index, threshold_allowlist, allowlist_diff, threshold_choice, content_hash,
    )
}

_STANDINGS = """dom AS (
  SELECT event_id, alliance, server FROM (SELECT event_id, alliance, server, count(*) AS n, min(pos) AS p FROM board GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY event_id, alliance ORDER BY n DESC, p) = 1
), ranked AS (
  SELECT r.*, dom.server, row_number() OVER (PARTITION BY r.event_id ORDER BY total_points DESC, first_pos) AS rank
  FROM (SELECT event_id, alliance, sum(coalesce(points, 0))::BIGINT AS total_points, min(pos) AS first_pos FROM board GROUP BY ALL) r
  JOIN dom ON r.event_id = dom.event_id AND r.alliance IS NOT DISTINCT FROM dom.alliance
), tagged AS (SELECT *, """ + q.label_tag("alliance") + " AS tag FROM ranked)"
_ALLOW = "SELECT event_id, arg_min(tag, rank) AS tag, arg_min(total_points, rank) AS total_points FROM {rows} WHERE server = '1001' AND tag <> '' AND total_points >= {least} GROUP BY event_id, lower(tag)"
_SNAP = f"""{BOARD_SQL}, early AS (
  SELECT event_id, rank, commander, alliance, server, points FROM rankings r
  WHERE scan_kind = 'incremental' AND scan_id = (SELECT min(scan_id) FROM rankings q WHERE q.event_id = r.event_id AND q.scan_kind = 'incremental')
  QUALIFY row_number() OVER (PARTITION BY event_id, rank ORDER BY row_id) = 1
), pairs AS (
  SELECT a.event_id, a.early_rank, b.later_pos FROM (SELECT event_id, commander, server, min(rank) AS early_rank FROM early WHERE commander <> '' GROUP BY ALL) a
  JOIN (SELECT event_id, commander, server, min(pos) AS later_pos FROM board WHERE commander <> '' GROUP BY ALL) b ON a.event_id = b.event_id AND a.commander = b.commander AND a.server = b.server
)"""
_CUT = """lined AS (
  SELECT e.*, p.later_pos, row_number() OVER (PARTITION BY e.event_id ORDER BY e.rank) AS n FROM early e LEFT JOIN pairs p ON e.event_id = p.event_id AND e.rank = p.early_rank
), cut AS (SELECT event_id, coalesce(min(n - 1) FILTER (rank <> n OR later_pos IS NULL OR points IS NULL), max(n)) AS cutoff FROM lined GROUP BY event_id)"""
_KEY = _CORE.replace("{}", "commander")
_NAMED = f"commander IS NOT NULL AND commander <> '{UNREADABLE}'"
# Labels in parts; the prefix tells two tables of them apart.
_PARTS = f"""{q.label_tag('label')} AS tag, {q.fold(q.label_name('label'))} AS fold"""
_KEYS = f"""{q.confusable_key('tag')} AS key, {q.fused_forms('tag')} AS fused"""


def _alike(a: str, b: str) -> str:
    return q.tag_confusable(*[f"{s}.{c}" for c in ("tag", "key", "fused") for s in (a, b)])


def _repairs(rows: str) -> str:
    """Repairs of the labels of ``rows`` (event_id, alliance) by the registry, as CTEs ending in ``repairs``."""
    return f"""seen AS (SELECT event_id, alliance, count(*) AS n_rows FROM {rows} GROUP BY ALL),
    labelled AS (SELECT *, {q.normal_label('alliance')} AS label FROM seen),
    mine0 AS (SELECT event_id, label, sum(n_rows) AS n FROM labelled GROUP BY ALL), mine1 AS (SELECT *, {_PARTS} FROM mine0), mine AS (SELECT *, {_KEYS} FROM mine1),
    prior1 AS (SELECT *, {_PARTS} FROM (SELECT DISTINCT {q.normal_label('alliance')} AS label FROM alliance_registry)), prior AS (SELECT *, {_KEYS} FROM prior1 WHERE tag <> ''),
    ends0 AS (SELECT event_id, label, unnest(list_transform(range(2, len(string_split(label, ' ')) + 1), lambda i: array_to_string(string_split(label, ' ')[i:], ' '))) AS ending FROM mine WHERE tag = ''),
    ends1 AS (SELECT event_id, label, {q.fold('ending')} AS fold, {q.stripped('label[:length(label) - length(ending)]')} AS prefix FROM ends0 WHERE ending <> ''),
    ends2 AS (SELECT event_id, label, fold, prefix[2:length(prefix) - 1] AS tag FROM ends1 WHERE length(prefix) >= 2 AND prefix[1] IN ('[', 'U', 'I', 'J', '1') AND prefix[length(prefix)] IN (']', 'U', 'I', 'J', '1')),
    ends AS (SELECT *, {_KEYS} FROM ends2),
    offers AS (
      SELECT a.event_id, a.label, b.label AS offer, a.n <= 2 AS may, 'known alliance' AS reason FROM mine a JOIN prior b ON a.fold = b.fold WHERE a.tag <> '' AND a.label <> b.label AND {_alike('a', 'b')}
      UNION ALL SELECT a.event_id, a.label, b.label, a.n <= 2, 'known alliance' FROM mine a JOIN mine b ON a.fold = b.fold AND a.event_id = b.event_id WHERE a.tag <> '' AND b.tag <> '' AND a.label <> b.label AND b.n > a.n AND {_alike('a', 'b')}
      UNION ALL SELECT a.event_id, a.label, b.label, true, 'bracket repair' FROM ends a JOIN prior b ON a.fold = b.fold WHERE {_alike('a', 'b')}
      UNION ALL SELECT a.event_id, a.label, b.label, true, 'bracket repair' FROM ends a JOIN mine b ON a.fold = b.fold AND a.event_id = b.event_id WHERE b.tag <> '' AND {_alike('a', 'b')}),
    decided AS (SELECT event_id, label, list_sort(list(DISTINCT offer)) AS c, bool_or(may) AS may, max(reason) AS why FROM offers GROUP BY ALL),
    repairs AS (SELECT l.event_id, l.alliance, CASE WHEN len(c) = 1 AND may THEN c[1] ELSE l.label END AS after, CASE WHEN len(c) = 1 AND may THEN why ELSE 'known alliance' END AS reason,
      CASE WHEN len(c) = 1 AND may OR c IS NULL THEN [] ELSE c END AS reviews FROM labelled l LEFT JOIN decided d ON l.event_id = d.event_id AND l.label = d.label)"""


# The registry of spellings as known names.
_REGISTRY = f"""spelt AS (SELECT server, {q.name_key('commander')} AS name_key, commander, alliance, n_seen FROM known_names WHERE kind = 'commander'),
    best0 AS (SELECT server, name_key, arg_min(commander, struct_pack(m := -n_seen, v := commander)) AS commander FROM spelt WHERE name_key <> '' AND server IS NOT NULL GROUP BY ALL),
    best AS (SELECT *, {q.confusable_key('commander')} AS look FROM best0),
    free AS (SELECT DISTINCT b.server, b.name_key, b.commander, b.look, s.alliance FROM best b JOIN spelt s USING (server, name_key) WHERE s.alliance IS NOT NULL),
    forms AS (SELECT server, lower(commander) AS observed, max(commander) AS canonical FROM known_names WHERE kind = 'commander' AND server IS NOT NULL AND commander IS NOT NULL GROUP BY ALL)"""


def _candidates(rows: str) -> str:
    """Near names of ``rows`` as CTEs ending in ``near``."""
    return f"""keyed AS (SELECT * FROM (SELECT *, {q.name_key('commander')} AS name_key, {q.confusable_key('commander')} AS look FROM {rows} WHERE {_NAMED}) WHERE name_key <> ''),
    near AS (SELECT DISTINCT n.event_id, n.rank, n.server, n.commander AS observed, f.commander AS known, n.alliance FROM keyed n JOIN free f ON n.server = f.server AND n.alliance = f.alliance
      WHERE {q.one_edit('n.look', 'f.look')} AND NOT EXISTS (SELECT 1 FROM best b WHERE b.server = n.server AND b.name_key = n.name_key)
        AND NOT EXISTS (SELECT 1 FROM keyed k WHERE k.event_id = n.event_id AND k.server = f.server AND k.name_key = f.name_key))"""


def _values(pairs: dict[str, str]) -> str:
    return ", ".join("('" + a.replace("'", "''") + "', '" + b.replace("'", "''") + "')" for a, b in pairs.items())


# Rows with a server at the end of some labels and some brackets lost, cleaned.
_MARKED = rf"""marked AS (SELECT * REPLACE (CASE WHEN rank % 7 = 0 THEN bare || ' S1001' ELSE bare END AS alliance) FROM (SELECT *, CASE WHEN rank % 11 = 0 THEN translate(alliance, '[]', '') ELSE alliance END AS bare FROM board)),
    fixes0 AS (SELECT before, max(after) AS after FROM (SELECT alliance_tag || ' ' || alliance_name AS before, alliance AS after FROM alliance_registry UNION ALL VALUES {_values(LABEL_FIXES)}) GROUP BY before),
    fixes1 AS (SELECT *, {q.label_tag('before')} AS tag_a, {q.label_tag('after')} AS tag_b, {q.fold(q.label_name('before'))} AS fold_a, {q.fold(q.label_name('after'))} AS fold_b FROM fixes0),
    fixes2 AS (SELECT *, {q.confusable_key('tag_a')} AS key_a, {q.confusable_key('tag_b')} AS key_b, {q.fused_forms('tag_a')} AS fused_a, {q.fused_forms('tag_b')} AS fused_b FROM fixes1),
    fixes AS (SELECT before, after FROM fixes2 WHERE NOT (tag_a <> '' AND tag_b <> '' AND fold_a = fold_b AND {q.tag_confusable('tag_a', 'tag_b', 'key_a', 'key_b', 'fused_a', 'fused_b')})
      AND (regexp_matches(before, '^\[[^]]+\]') OR after IN (SELECT {q.normal_label('alliance')} FROM alliance_registry))),
    whole AS (SELECT *, {q.brackets(q.stripped("coalesce(alliance, '')"))} AS raw FROM marked), without AS (SELECT *, {q.without_server('raw')} AS l FROM whole),
    fixed AS (SELECT w.*, coalesce(f.after, w.l) AS label FROM without w LEFT JOIN fixes f ON w.l = f.before),
    tagged0 AS (SELECT *, {q.label_tag('label')} AS tag, {q.label_name('label')} AS name FROM fixed),
    cleaned AS (SELECT event_id, row_id, rank, commander, points, {q.display('tag', 'name')} AS alliance, tag AS alliance_tag, name AS alliance_name, {q.server_code('server', 'raw', '1000')} AS server FROM tagged0)"""
_BATCH = f"""{BOARD_SQL}, {_MARKED}, {_repairs('cleaned')}, repaired AS (SELECT c.* REPLACE (r.after AS alliance), c.alliance AS was, r.reason, r.reviews FROM cleaned c JOIN repairs r ON c.event_id = r.event_id AND c.alliance IS NOT DISTINCT FROM r.alliance),
    {_REGISTRY}, {_candidates('repaired')}, named AS (SELECT r.*, f.canonical FROM repaired r LEFT JOIN forms f ON r.server = f.server AND r.commander = f.observed)"""
_PUBLISHED = "numbered AS (SELECT event_id, title, total_players, total_points, epoch_us(published_at) * 1000 + total_points % 1000 AS pos FROM war_manifest)"

ORACLE = {
    "parse_labels": f"SELECT row_id, {q.label_tag('alliance')} AS tag, {q.label_name('alliance')} AS name FROM rankings WHERE alliance IS NOT NULL",
    "lookalike_consolidation": f"""WITH {BOARD_SQL}, l AS (SELECT event_id, alliance, count(*) AS n, min(pos) AS p, {q.label_key('alliance')} AS k FROM board WHERE alliance <> 'No Alliance' GROUP BY ALL)
    SELECT event_id, alliance AS variant, first_value(alliance) OVER w AS canonical, n FROM l WINDOW w AS (PARTITION BY event_id, k ORDER BY n DESC, p) QUALIFY variant <> canonical""",
    "known_index": f"""WITH {BOARD_SQL}, f AS (SELECT server, {_KEY} AS name_key, commander, count(*) AS n, min(row_id) AS p FROM board WHERE {_NAMED} GROUP BY ALL)
    SELECT server, name_key, arg_min(commander, struct_pack(m := -n, p := p)) AS commander, count(*) AS n_spellings FROM f WHERE name_key <> '' GROUP BY server, name_key""",
    "known_names": f"""WITH {BOARD_SQL}, f AS (SELECT server, {q.name_key('commander')} AS name_key, commander, count(*) AS n, min(row_id) AS p FROM board WHERE {_NAMED} GROUP BY ALL)
    SELECT server, name_key, arg_min(commander, struct_pack(m := -n, p := p)) AS commander, count(*) AS n_spellings FROM f WHERE name_key <> '' GROUP BY server, name_key""",
    "known_labels": f"WITH {BOARD_SQL} SELECT DISTINCT {q.normal_label('alliance')} AS label FROM board",
    "clean_players": f"WITH {BOARD_SQL}, {_MARKED} SELECT row_id, alliance, alliance_tag, alliance_name, server FROM cleaned",
    "label_repairs": f"WITH {BOARD_SQL}, {_repairs('board')} SELECT event_id, alliance, after, reason, array_to_string(reviews, ' | ') AS reviews FROM repairs",
    "cleaning_batch": f"WITH {_BATCH} SELECT row_id, coalesce(canonical, commander) AS commander, alliance, {q.label_tag('alliance')} AS alliance_tag, {q.label_name('alliance')} AS alliance_name, server FROM named",
    "cleaning_changes": f"""WITH {_BATCH} SELECT event_id, rank, 'alliance' AS field, was AS before, alliance AS after, reason FROM named WHERE was IS DISTINCT FROM alliance
      UNION ALL SELECT event_id, rank, 'commander', commander, canonical, 'manual override' FROM named WHERE canonical <> commander""",
    "cleaning_reviews": f"""WITH {_BATCH}, asked AS (SELECT event_id, rank, coalesce(server, '') AS server, alliance AS observed, unnest(reviews) AS known FROM named)
      SELECT event_id, rank, 'alliance' AS field, server, observed, known, CASE WHEN {q.label_tag('observed')} <> '' THEN {q.label_name('observed')} ELSE observed END AS alliance FROM asked
      UNION ALL SELECT event_id, rank, 'commander', server, observed, known, alliance FROM near n WHERE NOT EXISTS (SELECT 1 FROM named m WHERE m.event_id = n.event_id AND m.rank = n.rank AND m.commander = n.observed AND canonical IS NOT NULL)""",
    "fuzzy_candidates": f"WITH {BOARD_SQL}, {_REGISTRY}, {_candidates('board')} SELECT * FROM near",
    "name_candidates": f"""WITH {BOARD_SQL}, keyed AS (SELECT * FROM (SELECT *, {q.name_key('commander')} AS name_key, {q.confusable_key('commander')} AS look FROM board WHERE {_NAMED}) WHERE name_key <> ''),
    before AS (SELECT e.event_id, k.server, k.name_key, k.commander, count(*) AS n, min(k.row_id) AS p FROM (SELECT DISTINCT event_id FROM keyed) e JOIN keyed k ON k.event_id < e.event_id WHERE k.server IS NOT NULL GROUP BY ALL),
    best0 AS (SELECT event_id, server, name_key, arg_min(commander, struct_pack(m := -n, p := p)) AS commander FROM before GROUP BY ALL), best AS (SELECT *, {q.confusable_key('commander')} AS look FROM best0),
    seen_with AS (SELECT server, name_key, alliance, min(event_id) AS since FROM keyed WHERE alliance IS NOT NULL GROUP BY ALL),
    free AS (SELECT b.event_id, b.server, b.name_key, b.commander, b.look, w.alliance FROM best b JOIN seen_with w ON b.server = w.server AND b.name_key = w.name_key AND w.since < b.event_id)
    SELECT DISTINCT n.event_id, n.rank, n.server, n.commander AS observed, f.commander AS known, n.alliance FROM keyed n JOIN free f ON n.event_id = f.event_id AND n.server = f.server AND n.alliance = f.alliance
    WHERE {q.one_edit('n.look', 'f.look')} AND NOT EXISTS (SELECT 1 FROM best b WHERE b.event_id = n.event_id AND b.server = n.server AND b.name_key = n.name_key)
      AND NOT EXISTS (SELECT 1 FROM keyed k WHERE k.event_id = n.event_id AND k.server = f.server AND k.name_key = f.name_key)""",
    "override_join": f"""WITH {BOARD_SQL}, f AS (SELECT server, lower(commander) AS observed, max(commander) AS canonical FROM known_names WHERE kind = 'commander' GROUP BY ALL)
    SELECT row_id, board.server, f.canonical AS commander FROM board JOIN f ON board.server = f.server AND board.commander = f.observed WHERE f.server IS NOT NULL AND f.observed IS NOT NULL""",
    "change_log": f"""WITH {BOARD_SQL}, c AS (SELECT row_id, alliance, alliance_name, {q.normal_label('alliance')} AS l FROM board), n AS (SELECT *, {q.label_name('l')} AS m FROM c)
    SELECT row_id, 'alliance' AS field, alliance AS before, l AS after FROM n WHERE alliance IS DISTINCT FROM l UNION ALL SELECT row_id, 'alliance_name', alliance_name, m FROM n WHERE alliance_name IS DISTINCT FROM m""",
    # Rows of a key are paired one early row after the other, then near names, each with a list of what is taken.
    "early_match": f"""WITH RECURSIVE {_SNAP}, parts AS (SELECT *, {q.name_key('commander')} AS key, regexp_replace(coalesce(server, ''), '^[Ss]+', '') AS sv, {q.fold(q.nfkc(f"regexp_replace(coalesce(alliance, ''), '{q.SPACE}', '', 'g')"))} AS gr
        FROM (SELECT 'a' AS side, event_id, rank AS o, commander, server, alliance FROM early UNION ALL SELECT 'b', event_id, pos, commander, server, alliance FROM board)),
    a AS (SELECT *, row_number() OVER (PARTITION BY event_id, key ORDER BY o) AS n FROM parts WHERE side = 'a'),
    bags AS (SELECT event_id, key, list(struct_pack(sv := sv, gr := gr, o := o) ORDER BY o) AS bag FROM parts WHERE side = 'b' GROUP BY ALL),
    step AS (SELECT event_id, key, 0::BIGINT AS n, NULL::BIGINT AS o_a, NULL::STRUCT(d INTEGER, o BIGINT, sv VARCHAR) AS pick, []::BIGINT[] AS used, '' AS sv FROM bags
      UNION ALL SELECT event_id, key, n, o_a, pick, list_append(used, pick.o), sv FROM (
        SELECT a.event_id, a.key, a.n, a.o AS o_a, s.used, a.sv, list_aggregate(list_transform(list_filter(bag, lambda x: NOT list_contains(s.used, x.o)), lambda x: struct_pack(d := 2 * (a.sv <> x.sv)::INTEGER + (a.gr <> x.gr)::INTEGER, o := x.o::BIGINT, sv := x.sv)), 'min') AS pick
        FROM step s JOIN a ON a.event_id = s.event_id AND a.key = s.key AND a.n = s.n + 1 JOIN bags ON bags.event_id = s.event_id AND bags.key = s.key) WHERE pick IS NOT NULL),
    exact AS (SELECT event_id, o_a, pick.o AS o_b, sv AS sv_a, pick.sv AS sv_b FROM step WHERE n > 0),
    home AS (SELECT event_id, sv_b AS home FROM exact WHERE sv_a = '' GROUP BY event_id, sv_b QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY count(*) DESC, min(o_a)) = 1),
    left_a AS (SELECT a.*, coalesce(nullif(a.sv, ''), home, '1001') AS pl FROM a LEFT JOIN home USING (event_id) WHERE key <> '' AND NOT EXISTS (SELECT 1 FROM bags WHERE bags.event_id = a.event_id AND bags.key = a.key)),
    left_b AS (SELECT b.*, coalesce(nullif(b.sv, ''), home, '1001') AS pl FROM parts b LEFT JOIN home USING (event_id) WHERE side = 'b' AND NOT EXISTS (SELECT 1 FROM exact e WHERE e.event_id = b.event_id AND e.o_b = b.o)),
    offers AS (SELECT x.event_id, x.o AS o_a, list(y.o::BIGINT) AS offered FROM left_a x JOIN left_b y ON x.event_id = y.event_id AND x.pl = y.pl AND x.gr = y.gr WHERE {q.two_edits('x.key', 'y.key')} GROUP BY ALL),
    lined_up AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY o_a) AS n FROM offers),
    settled AS (SELECT DISTINCT event_id, 0::BIGINT AS n, NULL::BIGINT AS o_a, []::BIGINT[] AS free, []::BIGINT[] AS used FROM offers
      UNION ALL SELECT event_id, n, o_a, free, CASE WHEN len(free) = 1 THEN list_append(used, free[1]) ELSE used END FROM (
        SELECT l.event_id, l.n, l.o_a, list_filter(offered, lambda x: NOT list_contains(t.used, x)) AS free, t.used FROM settled t JOIN lined_up l ON l.event_id = t.event_id AND l.n = t.n + 1))
    SELECT event_id, o_a::INTEGER AS early_rank, o_b AS later_pos FROM exact UNION ALL SELECT event_id, o_a::INTEGER, free[1] FROM settled WHERE len(free) = 1""",
    "clean_prefix": f"""WITH {_SNAP}, fine AS (
      SELECT event_id, rank, points FROM (SELECT *, bool_and(rank = n AND points IS NOT NULL) OVER (PARTITION BY event_id ORDER BY rank) AS ok
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY rank) AS n FROM early)) WHERE ok
    ), outside AS (SELECT b.event_id, b.points, coalesce(p.early_rank, 1000000000) AS at FROM board b LEFT JOIN pairs p ON b.event_id = p.event_id AND b.pos = p.later_pos WHERE b.points IS NOT NULL),
    good AS (SELECT f.event_id, max(f.rank) AS cutoff FROM fine f WHERE NOT EXISTS (SELECT 1 FROM outside o WHERE o.event_id = f.event_id AND o.at > f.rank AND o.points > f.points) GROUP BY ALL)
    SELECT e.event_id, coalesce(cutoff, 0) AS cutoff FROM (SELECT DISTINCT event_id FROM early) e LEFT JOIN good USING (event_id)""",
    "prefix_merge_renumber": f"""WITH {_SNAP}, {_CUT}, held AS (SELECT l.event_id, l.rank AS early_rank, l.points AS early_points, l.later_pos FROM lined l JOIN cut USING (event_id) WHERE l.rank <= cutoff),
    last AS (SELECT l.event_id, l.points AS cutoff_points FROM lined l JOIN cut USING (event_id) WHERE l.rank = cutoff)
    SELECT b.event_id, row_number() OVER (PARTITION BY b.event_id ORDER BY early_rank IS NULL, early_rank, pos) AS rank, commander, alliance, server, coalesce(early_points, points) AS points, b.rank AS later_rank,
      coalesce(early_rank IS NULL AND points > cutoff_points, false) AS passed
    FROM board b LEFT JOIN held h ON b.event_id = h.event_id AND b.pos = h.later_pos LEFT JOIN last ON b.event_id = last.event_id""",
    "latest_wins_dedup": f"WITH {_PUBLISHED} SELECT event_id, arg_max(title, pos) AS title, arg_max(total_players, pos) AS total_players, arg_max(total_points, pos) AS total_points, min(pos) AS pos FROM numbered GROUP BY event_id",
    "upsert_merge": f"""WITH {_PUBLISHED}, old AS (SELECT event_id, min(pos) AS pos FROM numbered WHERE total_points % 2 = 0 GROUP BY ALL),
    new AS (SELECT event_id, arg_max(title, pos) AS title, arg_max(total_points, pos) AS total_points, max(pos) AS p FROM numbered GROUP BY ALL)
    SELECT event_id, title, total_points, coalesce(old.pos, -1 - p) AS pos FROM new LEFT JOIN old USING (event_id)""",
    "latest_pointer": f"WITH {MANIFEST_SQL} SELECT event_id, event_date, event_date = (SELECT max(event_date) FROM manifest) AS is_latest FROM manifest",
    "scan_index": """SELECT event_id, scan_id, scan_kind, min(captured_at) AS started_at, max(captured_at) AS finished_at, count(*) AS total_players, sum(coalesce(points, 0))::BIGINT AS total_points,
      count(DISTINCT alliance) AS unique_alliances, arg_max(struct_pack(c := commander), struct_pack(p := coalesce(points, -1), r := -rank, c := commander)).c AS top_commander FROM rankings GROUP BY ALL""",
    "threshold_allowlist": f"WITH {BOARD_SQL}, {_STANDINGS} {_ALLOW.format(rows='tagged', least=1000000)}",
    "allowlist_diff": f"""WITH {BOARD_SQL}, {_STANDINGS}, wanted AS ({_ALLOW.format(rows="tagged", least=1000000)}), held AS ({_ALLOW.format(rows="(SELECT * FROM tagged WHERE rank % 3 <> 0)", least=200000)})
    SELECT DISTINCT event_id, tag, 'add' AS action FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.event_id = w.event_id AND lower(h.tag) = lower(w.tag))
    UNION SELECT event_id, tag, 'remove' FROM held h WHERE NOT EXISTS (SELECT 1 FROM wanted w WHERE h.event_id = w.event_id AND lower(h.tag) = lower(w.tag))""",
    "threshold_choice": f"WITH {MANIFEST_SQL} SELECT event_id, CASE WHEN unique_alliances - 175.0 > 0 THEN unique_alliances - 175.0 WHEN total_players - 1130.0 > 0 THEN total_players - 1130.0 ELSE 1.0 END::DOUBLE AS threshold FROM manifest",
    "content_hash": "SELECT doc_id, substr(sha1(text), 1, 10) AS version FROM documents",
}
