"""The facts and the monthly summary as DataFrame plans, and the jobs that write them."""
