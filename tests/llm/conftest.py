import pytest

CHUNKS = ("chunk_id long, text string, source string, source_dataset string, author string, author_slug string, title string, title_slug string, story_id long, story_key string, "
          "chunk_index int, total_chunks int, word_count int, genres array<string>, split string, ingested_at timestamp, bp string, h string, piece string, words string")


@pytest.fixture(scope="session")
def make_chunks(spark):
    """A chunks table from dicts; absent columns are null, and there are further columns with clashing names."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(CHUNKS)

    def make(rows):
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)

    return make


PROSE = ("The old miller walked slowly along the river, and he thought about the letter that his brother had sent from the city. "
         "When the evening came, she opened the door and looked at the garden, but nobody was there. "
         "It had been a long winter, and the people of the village were tired of the snow. ")
