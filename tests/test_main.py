from __future__ import annotations

import pytest

from ticketmart import __main__ as cli

WHERE = [
    "--database", "mart", "--drops", "/drops", "--checkpoint", "/progress",
    "--jdbc-url", "jdbc:example", "--jdbc-driver", "d", "--jdbc-user", "u",
]


def test_mart_from_arguments(spark, monkeypatch):
    monkeypatch.setenv("MART_DB_PASSWORD", "secret")
    mart = cli.mart_from(spark, cli.parser().parse_args(["daily", *WHERE, "--parts", "8"]))
    assert (mart.database, mart.drops, mart.checkpoint) == ("mart", "/drops", "/progress")
    assert mart.source.options == {"url": "jdbc:example", "driver": "d", "user": "u", "password": "secret"}
    assert mart.source.uuid_splits == {"sales": "sale_id", "customers": "customer_id"} and mart.source.parts == 8


def test_each_command_runs_its_load(spark, monkeypatch, database):
    where = ["--database", database, *WHERE[2:]]
    ran = []
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    monkeypatch.setattr(cli, "COMMANDS", {name: lambda mart, name=name: ran.append(name) for name in cli.COMMANDS})
    monkeypatch.setattr(cli.loads, "refresh_dimension", lambda mart, name: ran.append(name))
    commands = [*cli.COMMANDS, "venues", "partnerships"]
    for command in commands:
        cli.main([command, *where])
    assert ran == commands


def test_an_unknown_command_is_refused():
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["weekly", *WHERE])


def test_database_options():
    args = cli.parser().parse_args(["daily", *WHERE, "--fetch-size", "7", "--customer-parts", "3", "--keep-sale-time"])
    mart = cli.mart_from(None, args)
    assert mart.source.options["fetchsize"] == "7" and mart.source.table_parts == {"customers": 3} and mart.keep_sale_time


def test_the_third_party_step_obeys_the_checkpoint():
    from ticketmart.plans.refresh import third_party_step

    assert cli.COMMANDS["third-party-daily"] is third_party_step
