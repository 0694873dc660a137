"""Feature/model pipelines, workload stand-ins and end-to-end jobs."""
