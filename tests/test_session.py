from tabreg.session import checkpoint_root, shared_path, ship_package


def test_written_tables_go_under_the_session_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a.startswith(root + "/tabreg/x-") and a != b


def test_package_ships_to_python_workers(spark):
    ship_package(spark)

    def probe(it):
        import tabreg.operators.model as m
        for _ in it:
            yield m.__name__
    assert set(spark.sparkContext.parallelize(range(4), 2).mapPartitions(probe).collect()) == {"tabreg.operators.model"}


def test_no_local_folder_on_a_cluster():
    """Without spark.checkpoint.dir only a local session may make its own folder."""
    import pytest

    from tabreg.session import checkpoint_root

    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

        def set(self, k, v):
            self[k] = v

    class Context:
        path = None

        def getCheckpointDir(self):
            return self.path

        def setCheckpointDir(self, p):
            self.path = p

    class Session:
        def __init__(self, **conf):
            self.conf, self.sparkContext = Conf(conf), Context()

    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(Session(**{"spark.master": master}))
    assert checkpoint_root(Session(**{"spark.master": "local[4]"}))
    assert checkpoint_root(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:/x/"})) == "hdfs:/x"
