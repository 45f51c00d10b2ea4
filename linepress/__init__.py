"""linepress: preparation of parallel and monolingual text corpora on Spark."""
