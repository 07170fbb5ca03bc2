import random

import pytest
from hypothesis import given, settings, strategies as st

from ratingloom import schemas
from ratingloom.operators import registry
from tests.conftest import rows_of

# Users 0, 1 and 5: a gap at 2 to 4.
RATINGS = [(0, 1, 1.0), (1, 1, 1.0), (1, 2, 1.0), (5, 1, 1.0)]


def requests_of(spark, ids):
    return spark.createDataFrame(list(enumerate(ids)), schemas.USER_REQUESTS)


def test_known_by_existence_and_by_range(spark, make):
    ratings = make(RATINGS, schemas.RATINGS)
    requests = requests_of(spark, [0, 3, 5, 6, -1, None])
    by_range = registry.known_users(requests, ratings, "range").orderBy("request_id").collect()
    exists = registry.known_users(requests, ratings, "exists").orderBy("request_id").collect()
    assert [r.known for r in by_range] == [True, True, True, False, True, False]
    assert [r.known for r in exists] == [True, False, True, False, False, False]
    with pytest.raises(ValueError):
        registry.known_users(requests, ratings, "guess")


def one_by_one(ids, used, mode):
    """The rules taken literally."""
    largest, answers = max(used, default=0), []
    for request, wanted in enumerate(ids):
        if mode == "exists":
            new = wanted not in used
            largest += new
            answers.append((request, largest if new else wanted, new))
        else:
            new = wanted is None or wanted > largest
            if wanted is None:
                largest += 1
            elif new:
                largest = wanted
            answers.append((request, largest if new else wanted, new))
    return answers


@pytest.mark.parametrize("mode", ["exists", "range"])
def test_ids_for_a_few_requests(spark, make, mode):
    ids = [None, 3, 5, None, 9, None, 0, 8, -4]
    table = registry.allocate_users(requests_of(spark, ids), make(RATINGS, schemas.RATINGS), mode)
    answers = [tuple(r) for r in table.orderBy("request_id").collect()]
    assert answers == one_by_one(ids, {0, 1, 5}, mode)


@pytest.mark.parametrize("mode", ["exists", "range"])
def test_first_user_of_an_empty_table(spark, make, mode):
    table = registry.allocate_users(requests_of(spark, [None]), make([], schemas.RATINGS), mode)
    assert rows_of(table) == [(0, 1, True)]
    nothing = registry.allocate_users(requests_of(spark, []), make([], schemas.RATINGS), mode)
    assert rows_of(nothing) == []


@pytest.mark.parametrize("mode", ["exists", "range"])
@settings(max_examples=10, deadline=None)
@given(ids=st.lists(st.one_of(st.none(), st.integers(-3, 60)), min_size=1, max_size=60))
def test_ids_match_the_rules_taken_one_by_one(spark, mode, ids):
    ratings = spark.createDataFrame(RATINGS, schemas.RATINGS)
    table = registry.allocate_users(requests_of(spark, ids).repartition(3), ratings, mode)
    answers = [tuple(r) for r in table.orderBy("request_id").collect()]
    assert answers == one_by_one(ids, {0, 1, 5}, mode)


@pytest.mark.parametrize("mode", ["exists", "range"])
def test_many_requests_with_uneven_numbers(spark, make, mode):
    """Request numbers bunched at one end, one user asked for by a third of the requests."""
    dice = random.Random(4)
    numbers = sorted(dice.sample(range(3000), 1500) + [10**12 + k for k in range(20)])
    ids = [
        5 if dice.random() < 0.33 else dice.choice([None, dice.randrange(400)]) for _ in numbers
    ]
    requests = make(list(zip(numbers, ids)), schemas.USER_REQUESTS)
    table = registry.allocate_users(requests, make(RATINGS, schemas.RATINGS), mode)
    answers = [tuple(r) for r in table.orderBy("request_id").collect()]
    expected = one_by_one(ids, {0, 1, 5}, mode)
    assert answers == [(n, user, new) for n, (_, user, new) in zip(numbers, expected)]
