"""Vocabularies against values written here on their own. All literals in this file are fixed values."""

from jobmart.functions import vocab


def test_technologies():
    for group in (
        "python java c# javascript typescript go rust kotlin swift php ruby scala",
        "react angular vue svelte nodejs express django flask fastapi rails laravel",
        "sql spark hadoop kafka elasticsearch pandas numpy dbt airflow prefect snowflake bigquery redshift hive presto",
        "docker kubernetes jenkins terraform ansible prometheus grafana datadog newrelic linux aws azure gcp",
        "postgresql mysql mongodb redis cassandra dynamodb neo4j firebase memcached duckdb influxdb timescaledb",
    ):
        wanted = group.split()
        assert set(wanted) <= set(vocab.TECH_KEYWORDS)
    assert len(vocab.TECH_KEYWORDS) == 148
    repeated = sorted({w for w in vocab.TECH_KEYWORDS if vocab.TECH_KEYWORDS.count(w) > 1})
    assert repeated == ["bigquery", "dynamodb", "kafka", "kotlin", "postman", "scikit-learn", "swift"]
    assert vocab.TECH_KEYWORDS[:2] == ["python", "java"] and vocab.TECH_KEYWORDS[-2:] == ["zeromq", "pulsar"]


def test_labels():
    assert list(vocab.SENIORITY_PHRASES) == [
        "Entry", "Junior", "Mid-Level", "Senior", "Lead", "Principal", "Staff", "Manager", "Director", "VP", "C-Level",
    ]
    assert vocab.LOCATION_PHRASES == {
        "REMOTE": ["remote", "work from home", "wfh", "lam viec tu xa", "làm việc từ xa"],
        "HYBRID": ["hybrid", "remote and office", "office and remote", "linh hoat", "linh hoạt"],
        "ON_SITE": ["on site", "onsite", "in office", "at office", "office", "van phong", "văn phòng"],
    }
    assert list(vocab.EMPLOYMENT_PHRASES) == ["FULL_TIME", "PART_TIME", "INTERNSHIP"]
    assert vocab.SALARY_WORDS == ["negotiable", "competitive", "thoa thuan", "thỏa thuận"]
    assert vocab.UNKNOWN_LIKE == ["", "unknown", "n/a", "na", "none", "null"]


def test_roles():
    assert list(vocab.ROLE_ALIASES)[:6] == [
        "technical lead", "engineering manager", "it manager", "fullstack", "frontend", "backend",
    ]
    assert list(vocab.ROLE_ALIASES)[-1] == "software" and len(vocab.ROLE_ALIASES) == 43
    assert vocab.CRAWL_ROLE_SLUGS == [
        "backend", "frontend", "fullstack", "mobile", "python", "embedded", "game", "blockchain", "AI", "data", "devops",
        "cloud", "security", "qa", "it-support",
    ]
