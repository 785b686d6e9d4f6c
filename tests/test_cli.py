"""The jobs as commands: reports, exit status, and what they leave in the tables."""

import json
from datetime import timedelta

import pytest

from keelstone.functions import signing
from keelstone.operators import governance
from keelstone.plans import assembly, cli
from test_functions import SENTENCE
from test_operators import T0, envelope, events, port_events

SEED = bytes(range(32))


@pytest.fixture()
def run(spark, tmp_path, capsys):
    env = {"STORAGE_BACKEND": "local", "STORAGE_ROOT": str(tmp_path / "lake"), "STORAGE_ALLOW_LOCAL": "1"}
    (tmp_path / "lake").mkdir()

    def go(*argv, status=0, **more):
        capsys.readouterr()
        assert cli.main([str(a) for a in argv], env | more, spark) == status
        out = capsys.readouterr()
        assert bool(out.out) == (status == 0) and out.err.startswith("refused: ") == (status != 0)
        return json.loads(out.out) if out.out else out.err

    return go


@pytest.fixture()
def scope(tmp_path):
    return governance.Scope("platform", str(tmp_path / "lake"))


def test_a_file_goes_in_as_a_whole_or_not_at_all(run, tmp_path, spark, scope):
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.write_text("\n".join(json.dumps(envelope(k)) for k in (1, 2)))
    bad.write_text("\n".join(json.dumps(x) for x in (envelope(3), envelope(4, producer=""))))
    told = run("ingest-file", "--scope", "platform", "--input", good, "--report", tmp_path / "told.json")
    assert (told["written"], told["already_present"]) == (2, 0) and json.loads((tmp_path / "told.json").read_text()) == told
    assert run("ingest-file", "--scope", "platform", "--input", good)["already_present"] == 2
    assert "producer" in run("ingest-file", "--scope", "platform", "--input", bad, "--report", tmp_path / "no.json", status=1)
    assert not (tmp_path / "no.json").exists() and assembly.table(spark, scope, "bronze").read().count() == 2
    assert "holds" in run("ingest-file", "--scope", "mrv", "--input", good, status=1)
    run("ingest-file", "--scope", "platform", "--input", good, STORAGE_ALLOW_LOCAL="0", status=1)
    run("ingest-file", "--scope", "platform", "--input", tmp_path / "absent", status=1)


def test_a_topic_goes_to_bronze_and_quarantine_once(run, tmp_path, spark, scope):
    folder, keys = tmp_path / "in", tmp_path / "keys.json"
    folder.mkdir()
    (folder / "a.ndjson").write_text("\n".join([json.dumps(envelope(1)), "{", json.dumps(envelope(2))]))
    keys.write_text(json.dumps({"k": signing.b64url(signing.public_key(SEED))}))
    given = ("ingest-stream", "--scope", "platform", "--topic", f"{governance.PREFIXES['platform'][0]}x", "--folder", folder, "--keys", keys, "--checkpoint", tmp_path / "at")
    assert run(*given)["changed"] and not run(*given)["changed"]
    assert assembly.table(spark, scope, "bronze").read().count() == 2 and assembly.table(spark, scope, "bronze", "quarantine").read().count() == 1
    keys.write_text("{}")
    assert "no keys" in run(*given, status=1)
    assert "outside" in run(*[g if g != given[4] else "elsewhere" for g in given], status=1)


def test_vessels_and_tracks(run, tmp_path):
    made = [envelope(k, "vessels.observation.v1", fhir={"resourceType": "Bundle", "type": "message", "entry": [{"resource": {"resourceType": "Basic", "nmeaSentences": [SENTENCE]}}]}) for k in (1, 2)]
    path, other = tmp_path / "v", tmp_path / "o"
    path.write_text("\n".join(map(json.dumps, made)))
    other.write_text(json.dumps(envelope(3)))
    assert run("ingest-vessels", "--scope", "platform", "--input", path)["written"] == 2
    assert "no vessel" in run("ingest-vessels", "--scope", "platform", "--input", other, status=1)
    run("ingest-file", "--scope", "platform", "--input", path)
    assert run("tracks", "--scope", "platform")["trajectories"] == 0
    told = run("export", "--scope", "platform", "--output", tmp_path / "lake/out.parquet", "--id-columns", "source_first_event_id")
    assert (tmp_path / "lake/out.parquet").exists() and told
    assert "outside" in run("export", "--scope", "platform", "--output", tmp_path / "out.parquet", status=1)
    assert run("export", "--scope", "platform", "--output", tmp_path / "lake/out", "--whole-folder")["row_count"] == 1


def test_gold_of_a_month(run, tmp_path, spark, scope):
    assembly.table(spark, scope, "silver").overwrite(port_events(spark))
    given = ("gold", "--scope", "platform", "--period", "2026-03", "--reports", tmp_path)
    assert "go together" in run(*given, REPORT_SIGNING_KID="k", status=1)
    assert "32 bytes" in run(*given, REPORT_SIGNING_KID="k", REPORT_SIGNING_SEED="AAAA", status=1)
    told = run(*given)
    assert (tmp_path / f"{told['month']['run_id']}.csv").exists() and told["products"] == {"excise_stamp_facts": 0}
    with pytest.raises(SystemExit) as wrong:
        cli.main(["gold", "--scope", "platform", "--period", "2026-13"])
    assert wrong.value.code == 2


def test_retention_is_planned_unless_applied(run, spark, scope):
    table = assembly.table(spark, scope, "bronze")
    table.append_new(events(spark, [("a", {}, 0, "SECRET"), ("a", {}, 24 * 400, "SECRET")]).dropDuplicates(["event_id"]), "event_id")
    given = ("retention", "--scope", "platform", "--operator", "me", "--hot-days", 1, "--cold-years", 1, "--reference", (T0 + timedelta(days=401)).isoformat() + "+00:00" * (T0.tzinfo is None))
    planned = run(*given)
    assert planned["dry_run"] and planned["windows"] == 1 and table.read().count() == 2
    done = run(*given, "--apply")
    assert (done["deleted"], table.read().count()) == (1, 1)
    assert {r["mode"] for r in assembly.table(spark, scope, "bronze", "events_retention_audit").read().collect()} == {"plan-delete", "delete"}
    assert "beyond" in run(*given[:5], "--hot-days", 400, "--cold-years", 1, status=1)
