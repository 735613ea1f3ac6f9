"""CRM analytics as Spark jobs: landing, change handling, marts, quality and load health."""
