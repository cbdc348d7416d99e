import pytest
import yaml

from weir.plans.config import ConfigError, inline_transform, load_config, normalised_code, resolve_env
from weir.sources.kafka import kafka_options

BASE = """
name: demo
source:
  name: kafka
  sync_mode: stream
  topics: [{name: t, destination_id: p.d.t}]
  bootstrap_servers: WEIR_ENV_SERVERS
  batch_size: WEIR_ENV_BATCH
  message_encoding: utf-8
  consumer_config: {auto.offset.reset: latest, enable.auto.commit: false, session.timeout.ms: 6000}
  authentication:
    type: basic
    params: {username: "env://USER_NAME", password: 'a"b', other: 1}
destination:
  name: bigquery_streaming_v2
  config:
    project_id: p
    dataset_id: d
    unnest: true
    time_partitioning: {type: DAY, field: __inserted_at}
    record_schemas:
    - destination_id: p.d.t
      clustering_keys: [id]
      record_schema:
      - {name: id, type: INTEGER, mode: REQUIRED}
      - {name: payload, type: JSON, description: what}
transforms:
- label: any
  builtin: {name: json_events, cluster: c}
engine: {runner: {type: stream}}
"""
ENV = {"WEIR_ENV_SERVERS": "k:9092", "WEIR_ENV_BATCH": "50000", "USER_NAME": "me"}


def edited(edit):
    raw = yaml.safe_load(BASE)
    edit(raw)
    return yaml.safe_dump(raw)


def test_valid():
    config = load_config(BASE, ENV)
    assert config.source.batch_size == 50000 and config.source.username == "me" and config.source.group_id == "weir"
    assert config.source.skip_empty_value and not config.source.skip_invalid_keys and config.destination.max_rows == 5000
    table = config.destination.tables["p.d.t"]
    assert table.clustering == ("id",) and table.partition_field == "__inserted_at" and table.columns[0].required
    assert config.transform.name == "json_events" and "a\"b" not in repr(config)


@pytest.mark.parametrize(
    "edit",
    [
        lambda c: c.update(extra=1), lambda c: c["source"].update(extra=1), lambda c: c["source"].pop("authentication"), lambda c: c["source"].update(name="file"),
        lambda c: c["source"].update(sync_mode="full"), lambda c: c["source"].update(topics=[]), lambda c: c["source"].update(message_encoding="xml"),
        lambda c: c["source"]["authentication"].update(type="oauth"), lambda c: c["source"]["authentication"].update(schema_registry_type="other"),
        lambda c: c["destination"].update(name="file"), lambda c: c["destination"]["config"].update(unnest=False),
        lambda c: c["destination"]["config"].update(bq_max_rows_per_request=10001), lambda c: c["destination"]["config"].update(record_schemas=[]),
        lambda c: c["engine"]["runner"].update(type="batch"), lambda c: c.update(transforms=[]), lambda c: c["transforms"].append(c["transforms"][0]),
        lambda c: c["transforms"][0].update(python="x = 1"), lambda c: c["transforms"][0]["builtin"].update(name="nope"),
        lambda c: c["transforms"][0]["builtin"].update(columns_to_remove={}), lambda c: c["source"].update(batch_size="many"),
        lambda c: c["destination"]["config"]["record_schemas"][0]["record_schema"].append({"name": "r", "type": "RECORD"}),
        lambda c: c["transforms"][0].update(python="import os", builtin=None), lambda c: c["transforms"][0].update(python="not python (", builtin=None),
    ],
)
def test_refused(edit):
    with pytest.raises(ValueError):
        load_config(edited(edit), ENV)


def test_unset_variables_are_named():
    with pytest.raises(ConfigError, match="WEIR_ENV_SERVERS"):
        load_config(BASE, {"USER_NAME": "me"})
    with pytest.raises(ConfigError, match="USER_NAME"):
        load_config(BASE, {})


def test_env_values():
    env = {"X_A": "5", "X_B": "yes it is", "C": "true"}
    raw = {"a": "X_A", "b": {"b": "X_B"}, "c": "env://C", "d": ["X_A"], "e": "X_NONE"}
    assert resolve_env(raw, env, "X_") == {"a": 5, "b": {"b": "yes it is"}, "c": True, "d": ["X_A"], "e": None}


def test_deny_list():
    text = edited(lambda c: c["transforms"][0].update(builtin={"name": "debezium_unwrap", "cluster": "c", "columns_to_remove": {"t": ["a"]}}))
    assert load_config(text, ENV).transform.removed == {"t": ("a",)}


CODE = """
REMOVED = {"t": ["a", "b",]}
out = {**keys, "__cluster": "main"}
"""


def test_inline_code_is_compared_without_its_literals():
    seen = []

    class Any(dict):
        def get(self, digest, default=None):
            seen.append(digest)
            return "json_events"

    first = inline_transform(CODE, Any())
    other = "\n".join("    " + x + "  " for x in CODE.replace("main", "other").replace('["a", "b",]', "[]").splitlines())
    second = inline_transform(other, Any())
    assert seen[0] == seen[1] and first.cluster == "main" and first.removed == {"t": ("a", "b")} and second.cluster == "other"
    inline_transform(CODE.replace("**keys", "**other"), Any())
    assert seen[2] != seen[0]
    for bad in (CODE.replace("__cluster", "x"), CODE.replace('["a", "b",]', "open('x')")):
        with pytest.raises(ConfigError):
            inline_transform(bad, {seen[0]: "json_events"})
    assert normalised_code("\n  a\n    b  \n\n") == "a\n  b"


def test_repeated_keys_are_refused():
    with pytest.raises(ConfigError):
        load_config(BASE + "\nname: again\n", ENV)


def test_kafka_options():
    source = load_config(BASE, ENV).source
    options = kafka_options(source)
    assert options["subscribe"] == "t" and options["startingOffsets"] == "latest" and options["kafka.session.timeout.ms"] == "6000"
    assert 'password="a\\"b"' in options["kafka.sasl.jaas.config"] and "kafka.enable.auto.commit" not in options
    bounded = kafka_options(source, streaming=False, since_ms=5)
    assert bounded["startingTimestamp"] == "5" and bounded["endingOffsets"] == "latest" and "startingOffsets" not in bounded
