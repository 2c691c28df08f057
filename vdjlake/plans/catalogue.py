"""All queries outside the training-data subpackage."""

from vdjlake.plans import files, general, repertoire

FLAGSHIP = "pipeline_default"
QUERIES = {**repertoire.QUERIES, **general.QUERIES, **files.QUERIES}
ORACLE_SQL = {**repertoire.ORACLE_SQL, **general.ORACLE_SQL, **files.ORACLE_SQL}
