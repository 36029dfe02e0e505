"""Network and disk alerts: maxima per window.

spark-submit jobs/net_disk.py --net_csv IN --disk_csv IN --out OUT [--net_threshold X] [--disk_threshold X]
"""

from hostvigil.config import NET_DISK
from hostvigil.jobs.alerting import main

if __name__ == "__main__":
    main(NET_DISK, "net", "disk")
