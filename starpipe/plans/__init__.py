"""The whole star and the job around it."""
