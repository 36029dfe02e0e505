"""CPU and memory alerts: averages per window.

spark-submit jobs/cpu_mem.py --cpu_csv IN --mem_csv IN --out OUT [--cpu_threshold X] [--mem_threshold X]
"""

from hostvigil.config import CPU_MEM
from hostvigil.jobs.alerting import main

if __name__ == "__main__":
    main(CPU_MEM, "cpu", "mem")
