"""Survey analytics as Spark jobs: submissions, definitions, events and persons in, typed tables and reports out."""
