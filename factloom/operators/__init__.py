"""Single steps from DataFrame to DataFrame; none of them runs a job."""
