"""DataFrame in, DataFrame out. Only functions named ``check_*`` run a job."""
