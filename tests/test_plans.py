"""Physical plans: pushdown, pruning, partial aggregation, top-k, broadcast."""

import re

from playlog.plans import catalog as C


def _plan(df) -> str:
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_reads_pruned_pushed_scan(spark, sf_small):
    df = C.QUERIES["fouls_by_player_season"](spark, sf_small)
    txt = df._jdf.queryExecution().executedPlan().toString()
    pushed = txt.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert {"IsNotNull(player)", "EqualTo(is_foul,true)"} <= {f.strip() for f in pushed.split(", ")}
    # only the columns the report uses are read
    assert "ReadSchema: struct<season:string,is_foul:boolean,player:string>" in txt


def test_partial_aggregation_and_group_limit(spark, sf_small):
    txt = _plan(C.QUERIES["shooting_ratio_leaders"](spark, sf_small))
    assert "partial_count" in txt
    txt = C.QUERIES["buzzer_beaters"](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in txt


def test_global_top_is_take_ordered(spark, sf_small):
    txt = C.QUERIES["top_scorers"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in txt


def test_season_filter_prunes_partitions(spark, sf_small):
    txt = C.QUERIES["shooting_ratio_leaders_seasons"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    part = txt.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "season_start" in part and "IN (1995,1996,1997,1998,1999,2000)" in part


def test_roster_join_is_broadcast_when_small(spark, sf_small):
    txt = _plan(C.QUERIES["rewrite_audit"](spark, sf_small))
    assert "BroadcastHashJoin" in txt


def _text_scans(df) -> int:
    return _plan(df).split("== Initial Plan ==")[0].count("FileScan text")


def test_loads_read_the_stored_table_once_parsed(spark, sf_small):
    assert _text_scans(C.QUERIES["merge_logs"](spark, sf_small)) == 0  # the parsed table is stored
    from playlog.operators.ingest import events_table
    from playlog.sources import adapters as A

    log, roster = C.log_b(spark, sf_small), A.corpus_b_roster(spark, sf_small)
    assert _text_scans(events_table(log, roster)) == 1


def test_ingest_with_scores_reads_the_log_once(spark, sf_small, monkeypatch):
    """Every plan that the ingest writes: one of them scans the text, once."""
    from playlog.operators import ingest as I
    from playlog.session import scratch_path
    from playlog.sources import adapters as A

    scans = []
    write = I.write_events_table
    monkeypatch.setattr(I, "write_events_table", lambda ev, *a: (
        scans.append(ev._jdf.queryExecution().executedPlan().toString().count("FileScan text")), write(ev, *a))[1])
    out = I.ingest(C.log_b(spark, sf_small), A.corpus_b_roster(spark, sf_small), scratch_path(spark, "t"), with_scores=True)
    # scores are added on the stored parsed events; the text was read for those only
    assert scans == [0] and "FileScan text" not in out._jdf.queryExecution().executedPlan().toString()


def _nodes(plan) -> list:
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        todo += [p.children().apply(i) for i in range(p.children().size())]
        found.append(p)
    return found


def test_ingest_moves_lines_not_events(spark, sf_small, monkeypatch, tmp_path):
    """What the ingest deals by season are the lines with what they can't tell themselves, in the order of the
    written folders; the events are those of the plain parse and join."""
    from playlog.operators import ingest as I
    from playlog.operators.parse import parse_log
    from playlog.operators.roster import resolve_players
    from playlog.sources import adapters as A

    written = []
    write = I.write_events_table
    monkeypatch.setattr(I, "write_events_table", lambda ev, *a: (
        written.append(ev._jdf.queryExecution().optimizedPlan()), write(ev, *a))[1])
    odd = ["", "no tabs", "20200101H00A00\tx\t\t[H00] ", "bad\t1\t00:01:00\t[H00 1-0] Nobody Jump Shot: Made (2 PTS)"]
    log = C.log_a(spark, sf_small).unionByName(spark.createDataFrame([(x,) for x in odd], "value string"))
    roster = A.corpus_a_roster(spark, sf_small)
    got = I.ingest(log, roster, f"{tmp_path}/t", rebalance=True)
    plan, = written
    dealt, = [n for n in _nodes(plan) if n.nodeName() == "RebalancePartitions"]
    names = {dealt.output().apply(i).name() for i in range(dealt.output().size())}
    assert names == {"value", "player", "season_start"}
    assert plan.outputOrdering().apply(0).child().name() == "season_start"
    want = resolve_players(parse_log(log), roster).select(*I.EVENT_COLUMNS)
    assert got.count() == want.count() and got.select(want.columns).exceptAll(want).count() == 0


def test_documents_are_shuffled_once(spark, sf_small, no_broadcast):
    """With broadcasts off, the grouped documents meet their ids where they are."""
    with no_broadcast():
        txt = _plan(C._docs_b(spark, sf_small)).split("== Initial Plan ==")[0]
    before_collect = txt.split("collect_list", 1)[0]
    # above the aggregation of the documents: joins, but no exchange of them
    assert "ShuffledHashJoin" in before_collect and "Exchange" not in before_collect


def test_json_events_carry_no_document(spark, sf_small):
    """The rows that the explode makes hold the game id, not the record they come from."""
    txt = C.QUERIES["documents_json_round_trip"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    carried = re.search(r"Generate explode\([^)]*\), \[([^\]]*)\]", txt)[1]
    assert re.fullmatch(r"game_id#\d+", carried), carried


def _names(plan) -> set:
    return {plan.output().apply(i).name() for i in range(plan.output().size())}


def test_documents_move_each_line_number_once(spark, sf_small):
    """What is grouped into documents holds the line number, not its text beside it."""
    plan = C._docs_b(spark, sf_small)._jdf.queryExecution().optimizedPlan()
    grouped, = [n for n in _nodes(plan) if n.nodeName() == "Aggregate" and "_pl_report" in _names(n)]
    out, = [a for a in (grouped.output().apply(i) for i in range(grouped.output().size())) if a.name() == "_pl_report"]
    assert "_pl_line" in out.dataType().catalogString() and "idLineEvent" not in out.dataType().catalogString()


def test_roster_join_moves_lines_and_keys(spark, sf_small):
    """The columns that the scores need are parsed behind the join; the rows are those of the plain parse and join."""
    from playlog.operators import ingest as I
    from playlog.operators.parse import parse_log
    from playlog.operators.roster import resolve_players
    from playlog.sources import adapters as A

    odd = [None, "", "no tabs", "20200101H00A00\tx\t\t[H00] ", "bad\t1\t00:01:00\t[H00 1-0] Nobody Jump Shot: Made (2 PTS)"]
    log = C.log_b(spark, sf_small).unionByName(spark.createDataFrame([(x,) for x in odd], "value string"))
    roster = A.corpus_b_roster(spark, sf_small)
    got = I.resolved_lines(log, roster, keep=I.PLACES)
    join, = [n for n in _nodes(got._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join"]
    assert _names(join.left()) == {"value", "name_token", "team", "_pl_salt"}
    want = resolve_players(parse_log(log), roster).select("value", "player", "season_start", *I.PLACES)
    assert got.columns == want.columns
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_running_values_move_no_group_column_beside_its_key(spark, sf_small):
    """The rows that the window sorts hold the game once; scored events hold what the table can't tell."""
    from playlog.sources import adapters as A

    plan = A.corpus_b_scored(spark, sf_small)._jdf.queryExecution().optimizedPlan()
    windows = [_names(n.child()) for n in _nodes(plan) if n.nodeName() == "Window"]
    rows = [w for w in windows if "event_id" in w]
    assert rows and all("_pl_g0" in w and not w & {"game_id", "home", "away"} for w in rows)
