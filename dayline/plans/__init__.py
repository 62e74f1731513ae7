"""The flows: operators composed into the jobs a user schedules."""
